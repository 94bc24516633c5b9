"""Token files, byte-level BPE, packing, shards and fingerprints against brute force."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from millrace.llm import fingerprints, lp_packing, matrix_bpe, ranked_ids, size_shards
from millrace.llm.word_ids import TextEncoder, encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    "", " ", "  a  b ", "it's a''s test\n\n  x\t y \n", "Ünḯcode é ΑΣ Σ ΟΔΟΣ", "a\x1cb c", "日本語 テスト 2²½ x",
    " \x85 c", "<|endoftext|> hi <|startoftext|>", "x" * 500, "\n \n a", "tab\tb\r\n c", "İstanbul ǅ", "don't DON'T",
    " ́a é", "1234 567", "ß STRASSE ẞ", "🙂🙂 👍🏽", "a  ", "\n\n\nabc", "a" * 3000 + "b" * 900, "ab" * 300,
]


def library(path):
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_cached_pieces_give_the_ids_of_the_whole_text(path, corpus):
    texts = [*ODD, *(t or "" for _, t in corpus)]
    want = [e.ids for e in library(path).encode_batch(texts, add_special_tokens=False)]
    own = TextEncoder(path, cached=50)  # forgets all the time
    for _ in range(2):
        assert [ids.tolist() for text in texts for ids in own.encode([text])] == want


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab é'sS\n\t 12.!日\x1f\x85́Ω<|>"), max_size=40))
def test_any_text_is_cut_safely(text):
    for path, own in OWN.items():
        want = LIBRARIES[path].encode(text, add_special_tokens=False).ids
        assert own.encode([text])[0].tolist() == want


OWN = {p: TextEncoder(p) for p in (WORDS, BYTES)}
LIBRARIES = {p: library(p) for p in (WORDS, BYTES)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=40))
def test_variable_length_coding(values):
    values = np.array(values, np.uint32)
    assert (ranked_ids.unpack(*ranked_ids.pack(values), len(values)) == values).all()


def test_token_files(spark, docs, nothing, corpus, monkeypatch):
    monkeypatch.setattr(ranked_ids, "BLOCK_IDS", 100)
    rows = ranked_ids.round_trip(docs, WORDS).collect()
    encode = library(WORDS).encode
    texts = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0))
    own = {}
    for key, text in texts:
        own.setdefault(key, []).append(encode(text or "", add_special_tokens=False).ids + [2])
    assert len(rows) == len(corpus)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [k for k, _ in texts]
    start = 0
    for row in rows:
        assert row.start == start
        start += row.n_tokens
        assert (row.n_tokens, row.ids_crc32) in {(len(i), crc(i)) for i in own[row.doc_id]}
    assert ranked_ids.round_trip(nothing, WORDS).count() == 0


def test_frequent_ids_are_short():
    ids = np.array([40000] * 900 + [7, 8, 9] * 10 + list(range(300, 700)), np.uint32)
    content = b"".join(ranked_ids.file_bytes([1], [ids]))
    assert len(content) < len(ranked_ids.MAGIC) + 4 * 405 + 60 + len(ids) * 1.4 + len(ids) / 4


def test_byte_bpe(docs, nothing, corpus):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = matrix_bpe.MatrixBpe(RANKS, public_tokenizers.PATTERN)
    for text, (ids, shown) in zip(ODD, bpe.encode(ODD)):
        assert ids.tolist() == own.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()
        assert shown == ",".join(map(str, ids)).encode()

    def digests(text):
        ids = own.encode_ordinary(text)
        shown = ",".join(map(str, ids)).encode()
        return len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    rows = matrix_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert Counter(tuple(r) for r in rows) == Counter((i, *digests(t or "")) for i, t in corpus)
    assert matrix_bpe.round_trip(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abcé日-'s 1\n"), max_size=60))
def test_long_words_merge_like_short_ones(text):
    raw = text.encode()
    if raw:
        assert (BPE._heap(raw) == BPE._matrix([raw])[0]).all()


BPE = matrix_bpe.MatrixBpe(RANKS, public_tokenizers.PATTERN)


@pytest.mark.parametrize("capacity", [40, 128])
def test_packing_plan(capacity):
    rng = np.random.default_rng(capacity)
    histogram = Counter(np.minimum(capacity, rng.geometric(4 / capacity, 6000)).tolist())
    plan = lp_packing.solve(dict(histogram), capacity)
    given_out = Counter()
    for configuration, n in plan.items():
        assert n > 0 and sum(a * b for a, b in configuration) <= capacity
        for length, times in configuration:
            given_out[length] += n * times
    assert given_out == histogram
    least = -(-sum(a * b for a, b in histogram.items()) // capacity)
    assert sum(plan.values()) <= least * 1.02 + 2
    assert lp_packing.solve({}, capacity) == {}


@pytest.mark.parametrize(
    "histogram, known", [({1100: 5000, 300: 5000, 649: 2000}, 5000), ({900: 3000, 600: 4000, 500: 3000, 448: 1000}, 3556)]
)
def test_packing_near_the_bound(histogram, known):
    """``known``: a plan by hand, which no lower bound may exceed."""
    shares, bound = lp_packing.fractional(histogram)
    needed = sum(lp_packing.solve(histogram).values())
    assert sum(n * k for n, k in histogram.items()) / 2048 <= bound <= known
    assert needed == known
    for length, wanted in histogram.items():
        covered = sum(x * times for c, x in shares.items() for n, times in c if n == length)
        assert covered >= 0.85 * wanted  # it falls a little short, which the rest makes good, and may cover some twice


def test_packing(docs, nothing, corpus):
    rows = lp_packing.pack(docs, BYTES, capacity=256).collect()
    encode = library(BYTES).encode
    own = {}
    for key, text in corpus:
        own.setdefault(key, []).append(encode(text or "", add_special_tokens=False).ids + [0])
    assert sum(r.length for r in rows) == sum(len(i) for each in own.values() for i in each)
    sequences = {}
    for r in rows:
        assert any(crc(i[r.start : r.start + r.length]) == r.ids_crc32 for i in own[r.doc_id])
        assert r.length == 256 or r.piece == 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    assert lp_packing.pack(nothing, BYTES).count() == 0


def test_shards(docs, nothing, corpus, tmp_path):
    rows = size_shards.shards(docs, 4).collect()
    raw = [(i, (t or "").encode()) for i, t in corpus]
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len(t) + 1, zlib.crc32(t)) for i, t in raw
    )
    rows.sort(key=lambda r: (r.shard, r.slot))
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys)
    total, most = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for shard in range(4):
        own = [r for r in rows if r.shard == shard]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 4) <= most
    assert size_shards.shards(nothing).count() == 0
    size_shards.write_shards(docs, str(tmp_path / "shards"), 4)
    back = docs.sparkSession.read.parquet(str(tmp_path / "shards")).select("doc_id", "shard").collect()
    assert Counter(map(tuple, back)) == Counter((r.doc_id, r.shard) for r in rows)


def test_sketches_recover_differences():
    rng = np.random.default_rng(2)
    pairs = []
    for size in (0, 1, 5, 60, 400):
        shared = rng.integers(0, 2**63, size).astype(np.uint64)
        for extra in (0, 1, 30, 700):
            pairs.append((np.append(shared, rng.integers(0, 2**63, extra).astype(np.uint64)), shared))
            pairs.append((shared[: size // 2], np.append(shared, rng.integers(0, 2**63, extra).astype(np.uint64))))
    for (a, b), (only_a, only_b) in zip(pairs, fingerprints.differences(pairs)):
        assert set(only_a.tolist()) == set(a.tolist()) - set(b.tolist())
        assert set(only_b.tolist()) == set(b.tolist()) - set(a.tolist())


def test_fingerprints(spark, docs, nothing, corpus, make_text):
    frame = fingerprints.versions(docs.where("doc_id is not null").dropDuplicates(["doc_id"]))
    rows = {r.doc_id: r for r in frame.collect()}
    texts = {i: t or "" for i, t in corpus if i is not None}
    order = sorted(texts)
    assert sorted(rows) == order
    prints = {}
    for key, following in zip(order, [*order[1:], order[0]]):
        text, after, row = texts[key], texts[following], rows[key]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        for near, other in ((row.near_edited, changed), (row.near_next, after)):
            a, b = (Counter(fingerprints.digests(t).tolist()) for t in (text, other))
            differing = sum(((a - b) + (b - a)).values())
            both = sum(a.values()) + sum(b.values())
            assert near == pytest.approx(1 - differing / both if both else 1.0)
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
    assert len(set(prints.values())) == len(prints)
    assert rows[50].near_edited > 0.4 > rows[50].near_next
    assert fingerprints.versions(docs).count() == len(corpus)  # null and repeated ids too
    assert fingerprints.versions(nothing).count() == 0
    assert fingerprints.versions(docs.where("doc_id = 20")).first().near_next == 1.0


def test_fingerprints_of_large_ids(spark, make_text):
    """Ids above 2^53 that no double holds, up to both ends of the range, each have a row."""
    rng = np.random.default_rng(5)
    ids = sorted({*(2 * int(i) + 1 for i in rng.integers(-(2**62), 2**62, 60)), 2**63 - 1, 2**63 - 2, -(2**63) + 1})
    texts = {key: make_text(i, 2) for i, key in enumerate(ids)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in fingerprints.versions(docs).collect()}
    assert sorted(rows) == ids
    for key, following in zip(ids, [*ids[1:], ids[0]]):
        changed = fingerprints.edited(texts[key], texts[following])
        assert rows[key].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_special_tokens_in_a_text_get_their_own_ids(path, spark):
    texts = ["x<|endoftext|>y", "plain text", "<|startoftext|> a  b<|endoftext|><|endoftext|>\n c", "<|ENDOFTEXT|>", *ODD]
    plain = Tokenizer.from_file(path)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    own = encoder(path)
    assert [ids.tolist() for ids in own.encode(texts)] == want
    assert [ids.tolist() for text in texts for ids in own.encode([text])] == want
    docs = spark.createDataFrame(list(enumerate(texts[:4])), "doc_id long, text string")
    rows = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in ranked_ids.round_trip(docs, path).collect()}
    assert rows == {i: (len(ids) + 1, crc([*ids, 2])) for i, ids in enumerate(want[:4])}
    pieces = {r.doc_id: (r.length, r.ids_crc32) for r in lp_packing.pack(docs, BYTES).collect()}
    ids = [e.ids + [0] for e in Tokenizer.from_file(BYTES).encode_batch(texts[:4], add_special_tokens=False)]
    assert pieces == {i: (len(x), crc(x)) for i, x in enumerate(ids)}
