"""Corpus operators on small tables against brute force: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from histmill.llm import (byte_bpe, html_extract, line_dedup, minhash_dedup, multiset_hash, quality_rules, queries,
                          source_mix, suffix_dedup, toxicity, url_filter)
from histmill.llm.common import stage, word_count
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
RNG = np.random.default_rng(8)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, dropped int, copies int, size int"


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in rng.integers(0, 4000, n))


def rows():
    base = prose(120, 1)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    line = "the same long line that five documents hold, more or less"
    texts = [base, near, base.upper(), prose(200, 2) + "\n" + line, prose(80, 3) + "\n " + line.upper() + "\t", line,
             line + "\n" + line, prose(30, 4) + "\n" + line, None, "", "   \n\t", "one", "one", "One two",
             prose(3000, 5), prose(60, 6) + "\n" + " ".join(words[20:100]), "é" * 50 + "\n" + "#### $$$$ %%%%", base]
    langs = ["en", "de", None]
    out = [(i * 3, t, langs[i % 3], f"src{i % 4}" if i % 5 else None, 0, "k", 1, 7, i) for i, t in enumerate(texts)]
    return out + [out[0], (None, base, "en", "src0", 0, None, None, None, None), (None, line, None, None, 0, "", 0, 0, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return stage(spark.createDataFrame(rows(), SCHEMA).repartition(3))


@pytest.fixture(scope="module")
def nothing(docs):
    return stage(docs.limit(0))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def linked(width, percent=80):
    sets = defaultdict(list)
    for r in rows():
        w = words_of(lower(r[1] or ""))
        s = frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
        sets[r[0]].append(s)
    ids = sorted(i for i in sets if i is not None)
    comp = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    return comp, sets


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, width):
    comp, sets = linked(width)
    got = minhash_dedup.near_duplicates(docs, width=width).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    for r in got:
        assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
        assert (r.component_id, r.kept) == ((None, True) if r.doc_id is None
                                            else (comp[r.doc_id], comp[r.doc_id] == r.doc_id))


def test_one_of_each_group_stays(docs):
    comp, _ = linked(5)
    kept = minhash_dedup.drop_near_duplicates(docs).select(docs.columns).collect()
    assert Counter(r.doc_id for r in kept if r.doc_id is not None) == Counter(set(comp.values()))
    assert sum(r.doc_id is None for r in kept) == 2


def test_groups_of_edited_copies_lose_no_link(spark):
    """Copies with many edits in different places: chains and near misses."""
    rng = np.random.default_rng(4)
    base = [f"b{k}" for k in range(150)]
    texts = []
    for i in range(120):
        w = list(base)
        for k in rng.choice(150, int(rng.integers(0, 14)), replace=False):
            w[k] = f"x{rng.integers(0, 60)}"
        texts.append(" ".join(w))
    sets = [frozenset(zip(t.split(), t.split()[1:])) for t in texts]
    comp = list(range(len(texts)))
    for _ in range(len(texts)):
        before = list(comp)
        for a in range(len(texts)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
        if comp == before:
            break
    df = stage(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(df, width=2).collect()}
    assert got == dict(enumerate(comp)) and 1 < len(set(comp)) < len(texts)


def test_line_dedup(docs):
    held = defaultdict(set)
    strip = " \t\n\x0b\x0c\r"
    for r in rows():
        for x in (r[1] or "").split("\n"):
            k = lower(x.strip(strip))
            if len(k) >= 40 and r[0] is not None:
                held[k].add(r[0])
    want = []
    for r in rows():
        parts = (r[1] or "").split("\n")
        kept = [x for x in parts if not (r[0] is not None and len(held[lower(x.strip(strip))]) >= 5
                                         and r[0] != max(held[lower(x.strip(strip))]))]
        want.append((r[0], len(parts), len(parts) - len(kept), "\n".join(kept)))
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(docs).collect()]
    assert Counter(got) == Counter(want) and any(w[2] for w in want)


def test_mix_reaches_its_targets_and_repeats_itself(spark):
    data = [(i, f"s{i % 3}", int(n)) for i, n in enumerate(RNG.integers(0, 60, 6000))] + [(6000, None, 50), (6001, "z", 0)]
    df = stage(spark.createDataFrame(data, "doc_id long, source string, size long"))
    first, again = (sorted(map(tuple, source_mix.mix(df).collect()), key=str) for _ in range(2))
    assert first == again
    sizes = Counter()
    for _, s, n in data:
        sizes[s] += n
    target, taken = source_mix.source_targets(dict(sizes)), Counter()
    for _, s, size, source_size, t, copies in first:
        assert source_size == sizes[s] and t == pytest.approx(target[s]) and 0 <= copies <= 3
        taken[s] += copies * size
    assert all(abs(taken[s] - target[s]) <= 60 for s in sizes)


def test_mixed_rows_keep_their_columns(docs):
    got = source_mix.mixed_rows(docs)
    assert got.columns == docs.columns
    by_row = Counter(map(tuple, got.collect()))
    assert set(by_row) <= set(rows()) and max(by_row.values()) <= 6


def test_fingerprints_against_the_next_document(docs):
    unique = [r for r in rows() if r[0] is not None][:18]
    df = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in multiset_hash.edited_against_next(df).collect()}
    order = sorted({r[0]: r[1] or "" for r in unique}.items())
    assert sorted(got) == [i for i, _ in order]
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        edited = multiset_hash.edited_text(t, following)
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == str(multiset_hash.Fingerprint(t))
        assert r.edited_fingerprint == str(multiset_hash.Fingerprint(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert multiset_hash.edited_against_next(docs).count() == len(rows())


def test_tokens_of_documents(docs):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(path),
                            special_tokens={})
    got = byte_bpe.encode_documents(docs, path, public_tokenizers.PATTERN, keep=("doc_id", "size")).collect()
    want = Counter((r[0], r[8], tuple(lib.encode_ordinary(r[1] or "")), hashlib.sha256((r[1] or "").encode()).hexdigest())
                   for r in rows())
    assert Counter((r.doc_id, r.size, tuple(r.ids), r.decoded_sha256) for r in got) == want
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()


def test_quality_verdicts_follow_the_corpus(spark, docs):
    good = [(i, prose(80, 100 + i), "en", f"s{i % 2}") for i in range(240)]
    bad = [(1000 + i, " ".join(f"{w}###" for w in prose(80, 500 + i).split()), "en", "s0") for i in range(12)]
    df = stage(spark.createDataFrame(good + bad + [(2000, None, None, None), (2001, "", "en", "s0")],
                                     "doc_id long, text string, lang string, source string"))
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality_rules.judge(df.withColumn("n_words", F.lit("x"))).collect()}
    assert all(kept[g[0]] == (True, False) for g in good)
    assert not any(kept[b[0]][0] for b in bad)
    assert kept[2000] == kept[2001] == (False, True)
    assert quality_rules.judge(docs).count() == len(rows())


def test_passages(docs):
    got = suffix_dedup.repeated_passages(docs).collect()
    texts = defaultdict(list)
    for r in rows():
        texts[r[0]].append(words_of(lower(r[1] or "")))
    seen = defaultdict(set)
    for i, options in texts.items():
        for w in options:
            for k in range(len(w) - 49):
                seen[tuple(w[k:k + 50])].add(i)
    cover = defaultdict(set)
    for r in got:
        assert r.n_words >= 50 and r.other_id != r.doc_id
        cover[r.doc_id] |= set(range(r.start, r.start + r.n_words))
    for i, options in texts.items():
        if i is None:
            continue
        w = options[0]
        want = {k + d for k in range(len(w) - 49) if len(seen[tuple(w[k:k + 50])] - {None}) > 1 for d in range(50)}
        assert cover[i] == want
    assert cover


def test_passages_in_every_row_of_a_doc_id(spark):
    shared, again = prose(60, 1).split(), prose(70, 2).split()
    rows = [(1, " ".join(prose(9, 3).split() + shared)), (1, prose(300, 4)), (1, " ".join(again)), (1, " ".join(again)),
            (2, " ".join(shared + prose(5, 5).split())), (3, " ".join(again)), (4, prose(49, 6)), (5, prose(49, 6)),
            (6, prose(80, 7)), (6, prose(80, 7)), (None, " ".join(shared)), (7, ""), (8, None)]
    df = stage(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(tuple(r) for r in suffix_dedup.repeated_passages(df).collect())
    assert got == [(1, 0, 70, 3, 0), (1, 9, 60, 2, 0), (2, 0, 60, 1, 9), (3, 0, 70, 1, 0)]


def test_passages_of_frequent_lines(spark):
    # many documents share more words on the left only and others on the right only
    rng = np.random.default_rng(11)
    lines = [prose(20, 100 + k).split() for k in range(24)]
    texts = {i: [w for k in rng.integers(0, 24, 8) for w in lines[k]] for i in range(900)}
    holders = defaultdict(set)
    for i, w in texts.items():
        for k in range(len(w) - 49):
            holders[tuple(w[k:k + 50])].add(i)
    df = stage(spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string"))
    cover = defaultdict(set)
    for r in suffix_dedup.repeated_passages(df).collect():
        assert r.other_id != r.doc_id and r.n_words >= 50
        assert texts[r.doc_id][r.start:r.start + r.n_words] == texts[r.other_id][r.other_start:r.other_start + r.n_words]
        cover[r.doc_id] |= set(range(r.start, r.start + r.n_words))
    want = {i: {k + d for k in range(len(w) - 49) if len(holders[tuple(w[k:k + 50])]) > 1 for d in range(50)}
            for i, w in texts.items()}
    assert sum(map(len, want.values())) > 10_000
    assert {i: len(want[i] - cover[i]) for i in texts if want[i] != cover[i]} == {}


def test_toxicity_on_held_out_rows(spark):
    bad = ["grimble", "snarfy", "dolt", "blechlike"]
    rng = np.random.default_rng(6)
    data, labels = [], []
    for i in range(700):
        w = [f"w{k}" for k in rng.integers(0, 300, int(rng.integers(20, 90)))]
        toxic = int(i % 4 == 0)
        if toxic:
            for k in rng.choice(len(w), max(2, len(w) // 20), replace=False):
                w[k] = str(rng.choice(bad))
        data.append((i, " ".join(w), "en", 5))
        labels.append((i, toxic))
    data += [(None, None, "x", None), (9000, "", None, 1), (9001, "snarfy " * 5000, "en", 1)]
    df = stage(spark.createDataFrame(data, "doc_id long, text string, lang string, score int"))
    lab = stage(spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int"))
    model = toxicity.fit(df, lab)
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    out = [(got[i], t) for i, t in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((s >= 0.3) == bool(t) for s, t in out) >= 0.95 * len(out)
    assert got[None] == got[9000] == 0.0 and got[9001] > 0.9
    assert toxicity.fit(df, lab.limit(0)) is None
    assert {r.score for r in toxicity.score(df, None).collect()} == {0.0}


def test_url_verdicts(spark):
    rules = url_filter.parse_rules(queries.URL_RULES)
    urls = [None, "", "nothing", "http://", "HTTP://WWW.Example.COM/en/1?x=/es/", "https://a.example.com/en/",
            "http://example.com/english", "http://b.net/es/1#f", "http://net/fr/", "http://xnet/fr/2", "http://c.org/en/1",
            "ftp://www.example.com.evil.net/es/?a=1&b=2", "http://example.com", "x://y://z/p"] * 2
    df = stage(spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string"))
    for r in url_filter.judge(df, rules).collect():
        rest = (r.url or "").partition("://")[2]
        host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", rest, re.S).groups()
        host = lower(host)
        fit = [x for x in rules if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fit, key=lambda x: len(x.name), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best.name if best else None)
        assert r.verdict == best.verdict if best else r.verdict in ("allow", "block")


def test_trees_learn_url_labels(spark):
    rng = np.random.default_rng(7)
    rows_ = []
    for i in range(600):
        spam = i % 2
        host = f"{'cheap-win-' if spam else ''}h{rng.integers(0, 50)}.example.{'biz' if spam else 'org'}"
        rows_.append((f"http://{host}/{'x/' * int(spam)}{rng.integers(0, 9999)}", spam))
    lab = stage(spark.createDataFrame(rows_[:400], "url string, blocked int"))
    test = stage(spark.createDataFrame(rows_[400:], "url string, want int"))
    got = url_filter.judge(test, [], lab).collect()
    assert sum((r.verdict == "block") == bool(r.want) for r in got) >= 190


def test_main_text_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, None, "<p>x"), (3, None, "<p>x")],
                                  "page_id long, url string, html string")
    got = html_extract.main_text(pages).collect()
    assert len(got) == 4 and {r.text for r in got if r.page_id < 3} == {""}
    assert got[0].__fields__ == ["page_id", "url", "text"]


def test_empty_tables(nothing):
    assert minhash_dedup.near_duplicates(nothing).count() == 0
    assert minhash_dedup.drop_near_duplicates(nothing).count() == 0
    assert line_dedup.dedup_lines(nothing).count() == 0
    assert source_mix.mix(nothing).count() == 0
    assert multiset_hash.edited_against_next(nothing).count() == 0
    assert quality_rules.judge(nothing).count() == 0
    assert suffix_dedup.repeated_passages(nothing).count() == 0
    assert url_filter.judge(nothing.select(F.col("text").alias("url")), []).count() == 0
    assert html_extract.main_text(nothing.select(F.col("text").alias("html"))).count() == 0


def test_scores_are_fitted_on_whole_texts(spark, monkeypatch):
    rng = np.random.default_rng(12)
    texts = {}
    for i in range(160):
        w = [f"w{k}" for k in rng.integers(0, 200, 700)]
        if i % 2:
            w[int(rng.integers(700))] = "snarfy"
        texts[i] = " ".join(w)
    df = stage(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    lab = stage(spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, toxic int"))
    tops, plain = [], toxicity._fit_logistic
    monkeypatch.setattr(toxicity, "_fit_logistic", lambda x, y: tops.append((x, y)) or plain(x, y))
    model = toxicity.fit(df, lab)
    highest = toxicity.Scorer(model).highest(list(texts.values()))
    for top, toxic in zip(*tops[0], strict=True):
        assert min(abs(top - h) for i, h in zip(texts, highest, strict=True) if i % 2 == toxic) < 1e-4


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    res = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name])
    assert res["schema_match"] and res["value_match"], res


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(sum(k.startswith(f"op{n}_") for k in names) == 1 for n in range(1, 14)) and "pipeline" in names


def test_pipeline_runs_stage_by_stage(spark):
    import corpus_pipeline

    start = spark.read.parquet(f"{SF}/documents.parquet")
    df = start
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        df = stage(step(spark, df, SF))
        assert k == len(corpus_pipeline.STAGES) - 1 or df.columns == start.columns
    texts = {r.doc_id: r.text for r in start.collect()}
    assert df.count() and {r.doc_id for r in df.collect()} <= set(texts)
    assert df.agg(F.sum("n_tokens")).first()[0] > 0
    assert start.select(word_count(F.col("text")).alias("n")).filter("n is null").count() == 0


def test_rows_that_share_an_id_lose_no_text(spark):
    long, other = prose(300, 71), prose(40, 72)
    docs = spark.createDataFrame(
        [(1, None, "a"), (1, long, "b"), (3, "", "c"), (3, other, "d"), (4, prose(50, 73), "e"), (4, prose(50, 74), "f"),
         (5, long, "g"), (6, prose(50, 73), "h"), (7, "twice", "i"), (7, "twice", "j"), (None, long, "k")],
        "doc_id long, text string, component_id string")
    kept = minhash_dedup.drop_near_duplicates(docs, 5, 80)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    texts = Counter(t for _, t in got)
    assert texts[long] == 2 and got[None, long] == 1  # one of the group, and the row without id
    assert got[1, None] == 1 and got[3, ""] == 1 and got[3, other] == 1
    assert texts[prose(50, 73)] == 1 and got[4, prose(50, 74)] == 1 and got[7, "twice"] == 1
    assert minhash_dedup.drop_near_duplicates(docs.limit(0)).count() == 0


def test_mix_comes_near_each_target_on_skewed_sizes(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "abcd"[i % 4], int(n)) for i, n in enumerate(np.minimum(rng.pareto(1.1, 4000) * 30 + 5, 5000))]
    got = source_mix.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    assert all(abs(taken[s] - t) <= 0.01 * t for s, t in target.items())


def test_mixed_rows_share_the_copies_of_equal_rows(spark):
    rows = [(None, "same text here", "a", k) for k in range(7)] + [(1, "one", "a", 0), (1, "two", "a", 1), (2, None, None, 0),
                                                                  (3, "long " * 50, "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    mixed = source_mix.mixed_rows(docs)
    assert mixed.columns == docs.columns
    once, again = (Counter(map(tuple, source_mix.mixed_rows(docs.repartition(n)).collect())) for n in (1, 3))
    assert once == again and set(once) <= set(rows) and max(once.values()) <= 3
    words = sum(n * len((r[1] or "").split()) for r, n in once.items())
    sizes = {"a": 23, "b": 50, None: 0}
    assert abs(words - sum(source_mix.source_targets(sizes).values())) <= 53
    assert source_mix.mixed_rows(docs.limit(0)).count() == 0


def test_fingerprint_ranges_split_one_id_and_rows_without(spark):
    rows = [(None, f"none {k}") for k in range(60)] + [(5, f"five {k}") for k in range(60)] + [(k, f"text {k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = multiset_hash.edited_against_next(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    order = [r["text"] for r in docs.select("text", F.xxhash64("text").alias("th"), "doc_id").orderBy(
        F.col("doc_id").asc_nulls_first(), "th").collect()]
    wanted = [hashlib.sha256(multiset_hash.edited_text(t, order[(k + 1) % len(order)]).encode()).hexdigest()
              for k, t in enumerate(order)]
    assert sorted(r["edited_sha256"] for r in got) == sorted(wanted)
    find = multiset_hash.range_of(np.array([5, 5, 5, 9]))
    parts = spark.range(2000).select(find(F.lit(5).cast("long"), F.xxhash64("id")).alias("r")).groupBy("r").count().collect()
    assert {r["r"] for r in parts} == {0, 1, 2, 3} and max(r["count"] for r in parts) < 700


def test_limits_move_without_a_jump_as_a_group_grows(spark):
    def rows(n):
        words = " ".join(f"word{j}" for j in range(80))
        own = [(k, words + " #" * (k % 5), "en", "small") for k in range(n)]
        return own + [(1000 + k, words + " other#" * (k % 9), "en", "large") for k in range(300)]

    limits = []
    for n in range(98, 103):
        rated = quality_rules.base_counts(spark.createDataFrame(rows(n), "doc_id long, text string, lang string, source string"))
        got = {r["source"]: r["limits"] for r in quality_rules.thresholds(quality_rules.sketches(rated)).collect()}
        limits.append(got["small"])
    for a, b in zip(limits, limits[1:], strict=False):
        assert all(abs(a[r] - b[r]) <= 0.05 * max(abs(a[r]), 100) for r in a)
