"""Token alignment, Pareto mixing and line-wise resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from compare import SCALES, of_spark, of_sql
from millrace.llm import line_resampling, oracle, pareto_mix, queries, token_alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a", " ", "  ", "a ", " a  b ", "\n", "x\n\ny\t", "日本語 テスト🙂", "<|endoftext|> </s> <s>", "<0x41> é", "▁a", "a▁b",
    "\x00\x01", "a b", "naïve ﬁ ´a", "x" * 700, "日" * 90, "=" * 200 + " " * 77, "tab\t\tb", "aé" * 50,
]


def tokens(text):
    """Ids and byte ends of both sides by the libraries alone, or None."""
    raw = b" " + text.encode()
    shown_a = TOKENIZER.encode(" " + text, add_special_tokens=False).ids
    shown_b = PIECES.encode(text)
    table = token_alignment.byte_level()
    bytes_a = [bytes(table[c] for c in TOKENIZER.id_to_token(i)) for i in shown_a]
    bytes_b = [
        bytes([int(PIECES.id_to_piece(i)[1:-1], 16)]) if PIECES.is_byte(i) else PIECES.id_to_piece(i).replace("▁", " ").encode()
        for i in shown_b
    ]
    if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    return shown_a, bytes_a, shown_b, bytes_b


def groups(text):
    found = tokens(text or "")
    if not found:
        return []
    (ids_a, bytes_a, ids_b, bytes_b) = found
    ends_a, ends_b = np.cumsum([len(b) for b in bytes_a]).tolist(), np.cumsum([len(b) for b in bytes_b]).tolist()
    out, start = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        out.append(([i for i, e in zip(ids_a, ends_a) if start < e <= end], [i for i, e in zip(ids_b, ends_b) if start < e <= end]))
        start = end
    return out


TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)


def expected_alignment(rows):
    every = [(i, groups(t)) for i, t in rows]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for _, g in every]
    held = Counter(p for each in links for p in each)
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = Counter()
    for (doc_id, g), own in zip(every, links):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out[
            (
                doc_id, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()),
                sum(n for p, n in own.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in own.items()),
                hashlib.sha256(shown.encode()).hexdigest() if g else "", shown,
            )
        ] += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


@pytest.mark.parametrize("chars", [300, token_alignment.BATCH_CHARS])
def test_alignment(spark, docs, nothing, corpus, chars):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    rows = token_alignment.aligned(docs.select("doc_id", "text").union(more), A, B, keep_groups=True, chars=chars).select(COLUMNS).collect()
    want = expected_alignment([*corpus, *((100 + i, t) for i, t in enumerate(ODD))])
    assert Counter(tuple(r) for r in rows) == want
    assert sum(n for row, n in want.items() if row[1]) > 30
    assert token_alignment.aligned(docs, A, B).count() == len(corpus)  # clashing columns
    assert token_alignment.aligned(nothing, A, B).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.lists(st.integers(1, 5), min_size=1, max_size=40))
def test_group_labels(a, b):
    a_ends, b_ends = np.cumsum(a), np.cumsum(b)
    if a_ends[-1] < b_ends[-1]:
        a_ends = np.append(a_ends, b_ends[-1])
    elif b_ends[-1] < a_ends[-1]:
        b_ends = np.append(b_ends, a_ends[-1])
    cuts = sorted(set(a_ends.tolist()) & set(b_ends.tolist()))
    label_a, label_b = token_alignment.group_labels(a_ends, b_ends)
    assert label_a.tolist() == np.searchsorted(cuts, a_ends).tolist()
    assert label_b.tolist() == np.searchsorted(cuts, b_ends).tolist()


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab é's\n\t 12.!日\x00<0x>"), max_size=40))
def test_parts_of_a_text_encode_like_the_whole(text):
    side = token_alignment.sides(A, B)[1]
    assert side.apart
    if text:
        assert side.encode([text])[0].tolist() == PIECES.encode(text)


def test_links_in_steps(monkeypatch):
    texts = ["x" * 700, "日" * 90 + "é" * 40, None, "a b c"]
    sides = token_alignment.sides(A, B)
    whole = [x.tolist() for x in token_alignment.align(texts, *sides).linked(32000)]
    monkeypatch.setattr(token_alignment, "LINKS", 3)
    assert [x.tolist() for x in token_alignment.align(texts, *sides).linked(32000)] == whole


SOURCED = "doc_id long, text string, source string, size long, place int, ratio double, down int, upto long"


@pytest.fixture(scope="module")
def sourced():
    rng = random.Random(12)
    rows = []
    for i in range(1500):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "ü", "Z", None, "tiny"])
        n = min(3000, int(rng.paretovariate(0.7))) if source != "tiny" else rng.randint(0, 2)
        rows.append((i, "\t".join("w" * rng.randint(1, 3) for _ in range(n)), source))
    rows += [(5000, None, "a"), (5001, "", "a"), (5002, "\x0b\x0c \r\n", None), (None, "x y", "b"), (7, rows[7][1], rows[7][2])]
    rows += [(6000, None, "void"), (6001, "", "void"), (6002, "a b c", "")]
    return rows


def spark_mix(spark, rows, partitions=3, **more):
    frame = spark.createDataFrame([(*r, 9, 9, 0.5, 3, 4) for r in rows], SOURCED).repartition(partitions)
    return [r.asDict() for r in pareto_mix.mix(frame, **more).collect()]


def water_level(sizes, weights, percent, most):
    """Targets by reshare: what is above the bound goes to the others by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, list(names), sum(sizes.values()) * percent / 100
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total >= most * sizes[s]]
        if not above:
            return target | {s: left * weight[s] / total for s in free}
        for s in above:
            target[s] = most * sizes[s]
            free.remove(s)
        left -= sum(target[s] for s in above)
    return target


@pytest.mark.parametrize("weights, percent, most", [((3, 1, 2), 150, 2), ((1,), 60, 3), ((5, 1), 250, 4)])
def test_mix(spark, sourced, weights, percent, most):
    rows = spark_mix(spark, sourced, weights=weights, percent=percent, most=most)
    size = {i: len([w for w in re.split("[ \t-\r]+", t or "") if w]) for i, t, _ in sourced}
    words = Counter()
    for i, _, source in sourced:
        words[source] += size[i]
    aims = water_level(words, weights, percent, most)
    assert Counter((r["doc_id"], r["source"]) for r in rows) == Counter((i, s) for i, _, s in sourced)
    taken, smallest = Counter(), {}
    for r in rows:
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], words[r["source"]])
        assert r["target"] == pytest.approx(aims[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= most
        whole = math.floor(round(r["target"]) / r["source_size"]) if r["source_size"] else 0
        assert r["copies"] in (whole, whole + 1)  # certain copies, and one more for some
        taken[r["source"]] += r["taken"]
    for source, n in words.items():
        assert abs(taken[source] - aims[source]) <= 2 + aims[source] * 0.02
    again = spark_mix(spark, sourced, 7, weights=weights, percent=percent, most=most)
    key = lambda r: str(sorted(r.items()))
    assert sorted(map(key, again)) == sorted(map(key, rows))
    other = spark_mix(spark, sourced, weights=weights, percent=percent, most=most, seed=99)
    assert sorted(map(key, other)) != sorted(map(key, rows))


def test_mix_of_little(spark):
    assert spark_mix(spark, []) == []
    assert [r["taken"] for r in spark_mix(spark, [(1, None, None), (2, "", "a")])] == [0, 0]
    (row,) = spark_mix(spark, [(1, "a b c", "s")])
    assert (row["target"], row["taken"]) == (4.5, 6)  # 5 words are due


def test_less_odds_win(spark):
    """Within a source and class the extra copies go to the least draws."""
    rows = [(i, "w " * 20, "s") for i in range(200)]
    drawn = {r["doc_id"]: r["copies"] for r in spark_mix(spark, rows)}
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = [r.doc_id for r in frame.select("doc_id", pareto_mix.draw(pareto_mix.SEED).alias("u")).orderBy("u").collect()]
    assert [drawn[i] for i in order] == [2] * 100 + [1] * 100


def features(text, run, buckets):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    grams = [" ".join(found[i : i + k]) for k in range(1, run + 1) for i in range(len(found) - k + 1)]
    return found, [zlib.crc32(g.encode()) % buckets for g in grams]


@pytest.mark.parametrize("run, buckets, hot", [(1, 10_000, 1000), (3, 500, 1000), (2, 50, 5), (1, 10_000, 1)])
def test_resampling(spark, docs, nothing, corpus, monkeypatch, run, buckets, hot):
    monkeypatch.setattr(line_resampling, "HOT", hot)
    target = ["Ta lo mi", None, "", "kusen É é ku\nsen do", "STRASSE ẞ İ K 12ab", corpus[0][1]]
    wanted = spark.createDataFrame([(1, t) for t in target], "item_id long, text string")
    rows = line_resampling.resampled(docs, wanted, run=run, buckets=buckets, least_words=3, percent=30).collect()
    own = [(i, *features(t, run, buckets)) for i, t in corpus]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x, run, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    want = []
    for i, found, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        want.append((i, len(found), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    assert Counter(tuple(r)[:5] for r in rows) == Counter(want)
    order = sorted((w for w in want if w[1] >= 3), key=lambda w: (-w[4], w[0] is None, w[0] or 0))
    drawn = sorted((r for r in rows if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in drawn] == list(range(1, 30 * len(order) // 100 + 1))
    assert [(r.score, r.doc_id) for r in drawn] == [(w[4], w[0]) for w in order[: len(drawn)]]
    assert line_resampling.resampled(nothing, wanted, run=run, buckets=buckets).count() == 0
    assert line_resampling.resampled(docs, wanted.limit(0), run=run, buckets=buckets).count() == len(corpus)


def test_resampling_equals_sql(spark):
    name = "op13_line_resampling"
    folder = f"{SCALES}/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    assert of_spark(queries.registered()[name](spark, folder)) == of_sql(con, oracle.statements()[name])
