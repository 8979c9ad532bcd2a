"""Phrase mining, digest index and conversation repair against brute force on small tables: nulls,
empty and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from histmill.llm import conversation_repair, digest_index, phrases

# --- phrases ---------------------------------------------------------------------------------

def grams(keys, weights, least):
    """What equal_partitions finds, by counting."""
    out = []
    for depth in range(len(keys)):
        c = Counter()
        for row in zip(*[k.tolist() for k in keys[:depth + 1]], weights.tolist()):
            if all(x >= 0 for x in row[:-1]):
                c[row[:-1]] += row[-1]
        out.append(c)
    for depth in range(len(keys)):
        out[depth] = {g: n for g, n in out[depth].items()
                      if all(out[d].get(g[:d + 1], 0) >= least[d] for d in range(depth + 1))}
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 400), st.integers(1, 30), st.integers(1, 6), st.integers(0, 10**6))
def test_equal_partitions_count_all_prefixes(n, words, least, seed):
    rng = np.random.default_rng(seed)
    keys = [rng.integers(0, words, n)]
    for _ in range(2):
        deeper = rng.integers(-1, words, n)
        keys.append(np.where(keys[-1] < 0, -1, deeper))
    weights = rng.integers(1, 4, n)
    want = grams(keys, weights, [least] * 3)
    for d, (heads, sizes) in enumerate(phrases.equal_partitions(keys, weights, [least] * 3)):
        found = {tuple(int(k[h]) for k in keys[:d + 1]): int(s) for h, s in zip(heads, sizes)}
        assert len(found) == len(heads)
        assert found == want[d]


def mined(rows, max_words, min_count, top, percent=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = []
        candidates = [p for p, a in counts.items() if len(p) > 1 and a >= min_count]
        for p in candidates:
            a = counts[p]
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * counts[q] >= percent * a
                         and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in candidates)
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows(seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["ça", "ÉTÉ", "The", "of", "été"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?", " ; "]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60))))
            for _ in range(150)]
    hot = ["of the of the of the " * 80, "a\x01b \x00 a\x01b \x00", "", None, "   \t", ".", "x" * 5000 + " y"]
    return rows + [("en", t) for t in hot] + rows[:20]


def as_docs(spark, rows):
    return spark.createDataFrame([(*r, i, "l", 7) for i, r in enumerate(rows)],
                                 "lang string, text string, rank int, l string, n int").repartition(3)


@pytest.mark.parametrize("max_words, min_count, top", [(3, 3, 40), (4, 2, 2000), (2, 5, 5)])
def test_phrases_equal_brute_force(spark, monkeypatch, max_words, min_count, top):
    rows = phrase_rows()
    docs = as_docs(spark, rows)
    got = phrases.collocations(docs, max_words, min_count, top)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.select(columns).collect())) == mined(rows, max_words, min_count, top)


def test_hot_and_cold_routes_give_the_same_counts(spark):
    docs = as_docs(spark, phrase_rows(8))
    seen = []
    for share in (1, 10**9):  # no word is hot, every word is hot
        counts, totals = phrases.phrase_counts(docs, 3, 2, share)
        seen.append((sorted(map(tuple, counts.collect())), sorted(map(tuple, totals.collect()))))
    assert seen[0] == seen[1]


def test_buffers_and_slices_are_cut_without_loss():
    text = ("Alpha beta, gamma delta.\n" * 300).encode()
    whole = Counter(w for part in phrases._tokens(text) for w in part if w != phrases.BREAK)
    size, phrases.SLICE = phrases.SLICE, 100
    try:
        cut = [part for part in phrases._tokens(text)]
    finally:
        phrases.SLICE = size
    assert len(cut) > 50 and Counter(w for part in cut for w in part if w != phrases.BREAK) == whole
    assert whole[b"alpha"] == 300


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    counts = spark.createDataFrame([("en", "a", 1, 3_000_000_000_001), ("en", "b", 1, 3_000_000_000_007),
                                    ("en", "a b", 2, 2_999_999_999_999)], phrases.COUNTS)
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: (counts, totals))
    row = phrases.collocations(counts).first()
    assert row["score"] == 1000000 * 2_999_999_999_999**2 // (3_000_000_000_001 * 3_000_000_000_007)


def test_no_phrases_in_an_empty_table(spark):
    docs = as_docs(spark, phrase_rows()).limit(0)
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(docs).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


# --- digest index ----------------------------------------------------------------------------

def texts():
    return [(5, "a  b"), (2, "a\tb"), (9, "a b"), (2, "a b"), (None, "a\nb"), (7, None), (3, ""), (4, " "), (8, "\x0b\x0c"),
            (1, "A b"), (6, "long " * 40000), (10, "long  " * 40000), (None, "lost"), (None, "lost"), (11, "é"), (12, "é")]


def judged_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = min(ids, key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(t.encode()).hexdigest()
        stays = 1
        for i in ids:
            out[i, keep, len(ids), i == keep and stays == 1, sha] += 1
            stays -= i == keep
    return out


@pytest.mark.parametrize("parts", [1, 3])
def test_digests_judge_all_rows(spark, parts):
    docs = spark.createDataFrame([(*r, "k", 3, True) for r in texts()],
                                 "doc_id long, text string, digest string, row int, kept boolean").repartition(3)
    index = digest_index.scratch_index(spark)
    got = digest_index.judge(docs, index, parts).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")))
    rows = Counter(map(tuple, got.collect()))
    # of rows equal in id and text one stays, whichever it is
    assert rows == judged_by_hand(texts())
    index.close()


def test_index_outlives_its_session_and_buckets_are_merged(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    first = spark.createDataFrame([(1, "one"), (2, "two"), (3, "one ")], "doc_id long, text string")
    second = spark.createDataFrame([(0, "one"), (4, "four"), (5, "four"), (6, "two\n")], "doc_id long, text string")
    index = digest_index.DigestIndex(spark, path, 5)
    assert {r.doc_id for r in digest_index.deduplicate(first, index, "monday").collect()} == {1, 2, 3}
    index.close()
    again = digest_index.DigestIndex(spark, path, 5)
    assert {r.doc_id for r in digest_index.deduplicate(second, again, "tuesday").collect()} == {4, 6}
    # the same delivery once more changes nothing
    before = again.spark.table(again.seen).count(), again.spark.table(again.again).count()
    assert {r.doc_id for r in digest_index.deduplicate(second, again, "tuesday").collect()} == {4, 6}
    assert before == (again.spark.table(again.seen).count(), again.spark.table(again.again).count())
    sizes = {r.keep_id: r.group_size for r in again.repeated().collect()}
    assert sizes == {1: 2, 4: 2}
    plan = again.spark.table(again.seen).join(again.known("x").select("digest").hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text
    again.close()


def test_index_takes_an_empty_delivery(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    index = digest_index.scratch_index(spark)
    assert digest_index.judge(docs.limit(0), index, 4).count() == 0
    index.close()


# --- conversations ---------------------------------------------------------------------------

FITS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def cheapest(rows):
    """(cost, audit, repaired rows, faults) by search over (cost, audit)."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = re.sub("[\x20\x09-\x0d]+", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                      else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit, out, faults
        for role in ("user", "assistant"):
            if (state, role[0]) in FITS:
                heapq.heappush(heap, (cost + 2, audit + "I", i, FITS[state, role[0]], (*out, (role, ""))))
        if i < len(rows):
            _, own, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if faults[i] in ("", "truncated"):
                late = faults[i] == "truncated"
                if (state, own[:1]) in FITS:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, FITS[state, own[:1]], (*out, (own, text))))
                for role in ("user", "assistant"):
                    if (state, role[0]) in FITS:
                        heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, FITS[state, role[0]], (*out, (role, text))))


def repaired_by_hand(conversations, hurt=True):
    after = defaultdict(list)
    for conv, turn, role, text in conversations:
        rows = after[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if hurt else 9
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, rows in after.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        cost, audit, kept, faults = cheapest(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out.append((conv, gaps, *[faults.count(x) for x in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=str)


def talks(seed=5):
    rng = random.Random(seed)
    rows = []
    for conv in range(120):
        for k in range(rng.randint(0, 9)):
            turn = rng.choice([k, k, k, k, None, k + 5, rng.randint(0, 3)])
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "a", "Üser"])
            text = rng.choice(["Yes.", "No!", "so\n", "and then", " \t\n", "", None, "Ça va ?  ", "x" * rng.randint(1, 9) + "."])
            rows.append((conv, turn, role, text))
    long = [(1000, t, "user" if t % 2 == 0 else "assistant", f"{t % 700}" + "." * (t % 3 > 0)) for t in range(3000)]
    return rows + rows[:15] + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho.")] + long


@pytest.mark.parametrize("hurt", [True, False])
def test_repairs_equal_search(spark, hurt):
    rows = talks()
    talk = spark.createDataFrame([(*r, "x", 5) for r in rows],
                                 "conv_id long, turn long, role string, text string, audit string, cost int").repartition(4)
    got = conversation_repair.repair(talk, hurt)
    assert sorted(map(tuple, got.collect()), key=str) == repaired_by_hand(rows, hurt)


def test_repair_of_an_empty_table(spark):
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair(talk).count() == 0


def test_all_turns_null_and_turns_far_apart(spark):
    rows = [(1, None, "user", "a."), (1, None, "assistant", "b."), (2, -2**63, "user", "a."), (2, 2**63 - 1, "user", "b.")]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.gaps for r in conversation_repair.repair(talk, False).collect()}
    assert got == {1: 0, 2: None}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("suaoSUAOx", max_size=7), max_size=12))
def test_shared_nodes_give_the_same_audits(signatures):
    """Signatures in order of their reversed letters: each suffix is a node once."""
    automaton = conversation_repair.SuffixAutomaton()
    order = sorted({s[::-1] for s in signatures})
    role = {"s": "system", "u": "user", "a": "assistant", "o": "other"}
    for back in order:
        # a role and text of its own for every row, so that no row is a duplicate by chance
        rows = [(k, role.get(x.lower(), "user"), "" if x == "x" else f"{k}" + "." * x.islower()) for k, x in enumerate(back[::-1])]
        cost, audit, _, _ = cheapest(rows)
        assert automaton.audit(back) == (cost, audit)
    suffixes = {s[:k] for s in order for k in range(len(s) + 1)}
    assert automaton.made == len(suffixes | {""})
