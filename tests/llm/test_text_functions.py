"""Operators' building blocks against brute force and exact round trips, without Spark."""

import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from histmill.llm import byte_bpe, html_extract, minhash_dedup, multiset_hash, source_mix, suffix_dedup, toxicity

RANKS = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODER = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_bpe_encodes_like_the_library_and_decodes_back(text):
    text = text.encode("utf-8", "replace").decode()
    ids = ENCODER.encode(text)
    assert ids.tolist() == LIBRARY.encode_ordinary(text)
    decoder = byte_bpe.StreamDecoder(ENCODER.transducer.bytes_of)
    whole = b"".join(decoder.feed(ids[k:k + 3]) for k in range(0, len(ids), 3)) + decoder.finish()
    assert whole.decode() == text


@pytest.mark.parametrize("text", ["", " ", "a" * 3000, "é́" * 200, "don't 're's", "x\x1c\x1d  y　", "😀👩‍👩‍👧 ok",
                                  "".join(random.Random(4).choices("abcdefghij", k=4000)), "\r\n\t \n  a  b"])
def test_bpe_hard_texts(text):
    assert ENCODER.encode(text).tolist() == LIBRARY.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40))
def test_decoder_replaces_malformed_bytes(raw):
    ids = np.array([RANKS[bytes([b])] for b in raw], "<u4")
    decoder = byte_bpe.StreamDecoder(ENCODER.transducer.bytes_of)
    got = (decoder.feed(ids) + decoder.finish()).decode()
    valid = raw.decode("utf-8", "ignore")
    assert [c for c in got if c != "�"] == [c for c in valid if c != "�"]
    try:
        assert raw.decode() == got
    except UnicodeDecodeError:
        assert "�" in got


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 1000)), min_size=1, max_size=60), st.integers(0, 99))
def test_pivot_keeps_the_mass_and_leaves_one(rows, seed):
    p, size = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    before = p @ size
    rest = source_mix.pivot(p, size, np.random.default_rng(seed))
    assert abs(p @ size - before) < 1e-3
    assert all(x in (0, 1) for k, x in enumerate(p) if k != rest)


def test_pivot_keeps_each_expectation():
    rng, size, total = np.random.default_rng(1), np.array([5.0, 1, 9, 3, 3]), np.zeros(5)
    start = np.array([0.2, 0.5, 0.7, 0.4, 0.9])
    for _ in range(6000):
        p = start.copy()
        rest = source_mix.pivot(p, size, rng)
        if rest >= 0:
            p[rest] = rng.random() < p[rest]
        total += p
    assert np.abs(total / 6000 - start).max() < 0.03


def test_targets_stop_at_three_times_and_reshare():
    target = source_mix.source_targets({"b": 100, "a": 1, None: 100, "c": 0})
    assert list(target) == ["a", "b", "c", None]
    assert target["a"] == 3 and target["c"] == 0
    assert target["b"] == pytest.approx(198 * 2 / 3) and target[None] == pytest.approx(198 / 3)
    assert source_mix.source_targets({}) == {}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("ab c", max_size=12), max_size=8), st.randoms())
def test_multiset_hash_forgets_order_and_takes_edits(parts, rnd):
    shuffled = list(parts)
    rnd.shuffle(shuffled)
    a, b = multiset_hash.Fingerprint("\n".join(parts)), multiset_hash.Fingerprint("\n".join(shuffled))
    assert str(a) == str(b) and a.likeness(b) == 1.0
    b.insert("something else").delete("something else")
    assert str(a) == str(b)
    assert str(b.insert("something else")) != str(a)


def test_likeness_follows_what_is_shared():
    words = [f"w{i}" for i in range(600)]
    full, half = multiset_hash.Fingerprint(" ".join(words)), multiset_hash.Fingerprint(" ".join(words[:300]))
    other = multiset_hash.Fingerprint(" ".join(f"x{i}" for i in range(600)))
    assert full.likeness(other) < 0.3 < full.likeness(half) < 0.9


def test_estimate_of_b_bit_signatures():
    rng, hashes = np.random.default_rng(2), minhash_dedup.WordHashes()
    words = [f"w{i}" for i in rng.integers(0, 10**6, 500)]
    for cut in (0, 20, 60, 200):
        other = words[cut:] + [f"z{i}" for i in range(cut)]
        a, b = (minhash_dedup.shingle_set(" ".join(w), 2, hashes) for w in (words, other))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x = minhash_dedup.packed_bits(minhash_dedup.minima(a)) ^ minhash_dedup.packed_bits(minhash_dedup.minima(b))
        x = x.view(np.uint64)
        off = sum(bin(int((v | v >> np.uint64(1)) & np.uint64(0x5555555555555555))).count("1") for v in x)
        assert abs(((1 - off / 256) - 0.25) / 0.75 - true) < 0.16


def test_shared_passages_share_a_minimiser():
    rng, hashes = random.Random(3), suffix_dedup._WordHashes()
    shared = [f"s{rng.randrange(9000)}" for _ in range(50)]
    kept = []
    for side in "ab":
        w = [f"{side}{i}" for i in range(77)] + shared + [f"{side}x{i}" for i in range(30)]
        h = suffix_dedup.grams(suffix_dedup.word_hashes(" ".join(w), hashes))
        kept.append(set(h[suffix_dedup.minimisers(h, 41)].tolist()))
        plain = [k + int(h[k:k + 41].argmin()) for k in range(len(h) - 40)]
        at, first, n = suffix_dedup.anchors(h, 41)
        assert [(p, plain.index(p), plain.count(p)) for p in sorted(set(plain))] == list(zip(at, first, n, strict=True))
    assert kept[0] & kept[1]


def test_gradients_of_the_recurrent_network():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity._initial(rng, 6).items()}
    ids, chars = np.array([0, 1, 2, 3]), np.zeros((4, toxicity.CHAR_FEATURES), int)
    chars[:, :3] = rng.integers(1, 50, (4, 3))
    at, mask = rng.integers(0, 4, (7, 5)), np.ones((7, 5, 1))
    mask[5:, 2] = mask[3:, 4] = 0
    y, w = np.array([0, 1, 1, 0, 1.0]), np.ones(5)
    _, g = toxicity.gradients(p, ids, chars, at, mask, y, w)
    for k in ("w", "b", "uf", "ub", "att", "att_v", "out", "bias"):
        i = tuple(rng.integers(0, n) for n in p[k].shape)
        old, slope = p[k][i], []
        for e in (1e-3, -1e-3):
            p[k][i] = old + e
            slope.append(toxicity.gradients(p, ids, chars, at, mask, y, w)[0])
        p[k][i] = old
        assert g[k][i] == pytest.approx((slope[0] - slope[1]) / 2e-3, abs=2e-5)


def test_windows_cover_every_word():
    for n in (1, 16, 31, 32, 33, 48, 49, 100):
        starts = toxicity.window_starts(n)
        assert {i for s in starts for i in range(s, s + toxicity.WINDOW)} >= set(range(n))
    assert list(toxicity.window_starts(0)) == []


def test_marginals_are_exact_on_a_small_tree():
    page = html_extract.parse("<body><nav><a href=x>Home</a></nav><div><p>One two three.</p><p>Four.</p></div></body>")
    forest = html_extract.Forest([page], html_extract._Hashes())
    rng = np.random.default_rng(3)
    theta, edge = rng.normal(size=html_extract.FEATURES), rng.normal(size=(2, 2, 2))
    unary = np.bincount(forest.rows, theta[forest.cols], forest.n)
    weight, total = np.zeros(forest.n), 0.0
    for code in range(2 ** forest.n):
        x = [(code >> i) & 1 for i in range(forest.n)]
        s = sum(unary[i] * x[i] for i in range(forest.n))
        s += sum(edge[forest.kind[i], x[forest.parent[i]], x[i]] for i in range(forest.n) if page.parent[i] >= 0)
        total += np.exp(s)
        weight += np.exp(s) * np.array(x)
    p, _ = forest.marginals(theta, edge)
    assert np.allclose(p, weight / total)


def test_markup_that_is_broken():
    page = html_extract.parse('<p>a &amp; b<br>c<b>d<p>e&nbsp;f<script>var x="</p>";</script><ul><li>g<li>h</ul><!-- x --><a hre')
    assert [t for t in page.text if t] == ["a & b cd", "e f", "g", "h"]
    for source in (None, "", "<", "<<>", "&#", "<div", "</div></p>", "<!--", "<script>", "<style>x", "<p class='"):
        html_extract.parse(source)


def test_extraction_learns_from_self_labelled_pages():
    rng = np.random.default_rng(1)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n)) + "."

    def page(tag, close):
        body = [prose(int(rng.integers(3, 60))) for _ in range(4)]
        return body, (f"<html><body><nav><ul><li><a href=/>{prose(1)}</a></ul></nav>{tag}<h1>{body[0]}</h1>"
                      + "".join(f"<p>{b}</p>" for b in body[1:]) + f"{close}<div class='cookie-notice'>{prose(8)}</div>"
                      f"<footer>&copy; {prose(3)}</footer></body></html>")

    model = html_extract.train(html_extract.labelled_pages([page("<article>", "</article>")[1] for _ in range(30)]))
    for tag, close in (("<article>", "</article>"), ("<main>", "</main>"), ("<div class='content'>", "</div>")):
        got = 0
        for _ in range(20):
            body, source = page(tag, close)
            got += html_extract.extract([source], model)[0] == "\n".join(body)
        assert got >= 18


@pytest.mark.parametrize("tag", sorted(html_extract.SILENT - html_extract.RAW - {"head"}))
def test_unclosed_silent_elements_keep_the_rest(tag):
    def text(source):
        return " ".join(t for t in html_extract.parse(source).text if t)

    assert "the article" in text(f"<p>before</p><{tag} class=x><div><p>the article</p></div>")
    assert "the article" in text(f"<{tag}>one<{tag}>two</{tag}><p>the article</p>")
    assert text(f"<p>a</p><{tag}><i>no</i></{tag}><p>b</p>") == "a b"


def test_silent_elements_that_nest_or_do_not():
    def text(source):
        return " ".join(t for t in html_extract.parse(source).text if t)

    assert text("<svg><svg>x</svg>y</svg><p>b</p>") == text("<svg><svg/>y</svg><p>b</p>") == "b"
    assert text("<button>x<button>y</button><p>b</p>") == "b"
    assert html_extract.parse("<svg>" * 3000 + "<p>b</p>").text[-1] == "b"


def test_all_attribute_words_count():
    page = html_extract.parse(f'<div class="{"px flex " * 20}" id="comments"><p>x</p></div>')
    assert page.names[1][-1] == "comments"


@pytest.mark.parametrize("run", ["donaudampfschiffer", "abcdefghijklmnopqrst", "you_are_a_very-stupid_person_indeed",
                                 "".join(chr(0x4e00 + k) for k in range(3001)), "ab\u00a0cd" * 700])
def test_every_character_of_a_run_is_read(run):
    words = toxicity.words_of(run)
    texts = [w.decode() for w in words]
    assert max(map(len, texts)) <= toxicity.PIECE
    assert {run[k:k + 3] for k in range(len(run) - 2)} <= {t[k:k + 3] for t in texts for k in range(len(t) - 2)}
    # whatever is as long as the overlap lies within one piece
    n = toxicity.PIECE - toxicity.PIECE_STEP
    assert all(any(run[k:k + n] in t for t in texts) for k in range(0, len(run) - n + 1, 97))
    for w, t in zip(words, texts, strict=True):
        seen = toxicity.char_features(w)
        assert len(seen) <= toxicity.CHAR_FEATURES
        assert {1 + zlib.crc32(g.encode()) % (toxicity.CHAR_BUCKETS - 1)
                for g in (f"^{t}$"[k:k + 3] for k in range(len(t)))} <= set(seen)
    ids, chars = toxicity.Vocabulary({}).rows(words)
    assert (chars > 0).any(axis=1).all()


@pytest.mark.parametrize("seed", range(5))
def test_size_classes_leave_a_short_document(seed):
    rng = np.random.default_rng(seed)
    size = np.concatenate([rng.integers(5, 200, 900), rng.integers(2000, 9000, 30), [60_000]]).astype(float)
    p = np.full(len(size), 0.37)
    wanted = float(p @ size)
    rest = source_mix.round_by_class(p, size, rng)
    assert rest < 0 or size[rest] <= 4 * size.min()
    assert abs(float(p @ size) - wanted) < 1
    assert all(x in (0.0, 1.0) for k, x in enumerate(p) if k != rest)


def test_size_classes_keep_each_expectation():
    size = np.array([700.0, 300, 130, 120, 60, 50, 45, 20, 15, 9, 4, 3])
    total = np.zeros(len(size))
    for seed in range(6000):
        p = np.full(len(size), 0.4)
        source_mix.round_by_class(p, size, np.random.default_rng(seed))
        total += p
    assert np.abs(total / 6000 - 0.4).max() < 0.05


def test_likeness_of_long_repetitive_texts():
    long, shorter = (multiset_hash.Fingerprint("word " * n) for n in (100_000, 95_000))
    assert 0.99 < long.likeness(shorter) < 1
    assert multiset_hash.Fingerprint("word " * 33_000).likeness(multiset_hash.Fingerprint("word " * 32_000)) > 0.99


def test_unmatched_tags_on_a_deep_page_take_linear_time():
    import time

    for many in ("</section>", "</p>", "<li></li>", "<tr></tr>"):
        source = "<div>" * 8000 + many * 100_000 + "<p>the article</p>"
        began = time.process_time()
        assert html_extract.parse(source).text[-1] == "the article"
        assert time.process_time() - began < 5


def test_long_articles_are_sampled_over_their_whole_length(monkeypatch):
    seen = []
    monkeypatch.setattr(html_extract, "variant", lambda a, spare, rng: seen.append(a) or "<p data-y=1>x</p>")
    blocks = [f"Paragraph number {k} of the article." for k in range(200)]
    html_extract.labelled_pages(["<html><body><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article></body></html>"])
    whole = max(seen, key=lambda a: sum(b in blocks for b in a))
    assert any(b in blocks[150:] for a in seen for b in a) and len(whole) <= html_extract.BLOCKS


def test_states_are_bounded_inside_a_piece(monkeypatch):
    monkeypatch.setattr(byte_bpe, "STATES", 3000)
    monkeypatch.setattr(byte_bpe, "BLOCK", 512)
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rnd = random.Random(4)
    run = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=120_000))
    library = tiktoken.Encoding("b", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    transducer = byte_bpe.Transducer(ranks)
    assert list(transducer.feed(run.encode())) == library.encode_ordinary(run)
    assert len(transducer._states) <= 3000 + 512 + 1


def test_a_long_run_of_letters_fits_in_little_memory():
    code = """
import resource, numpy as np, public_tokenizers
from histmill.llm import byte_bpe
transducer = byte_bpe.Transducer(byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
run = bytes(np.random.default_rng(5).integers(97, 123, 1_000_000, dtype=np.uint8))
assert b"".join(transducer.bytes_of[i] for i in transducer.feed(run)) == run
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                          env={**os.environ, "PYTHONPATH": os.pathsep.join(p for p in sys.path if p)})
    assert int(done.stdout.split()[-1]) < 500
