"""Token counts, packing, language model and license scan against plain versions."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from edge import base_rows, documents, prose, words_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from oracle import compare, connect
from tokenizers import Tokenizer

from chroniq.llm import license_scan, lm, packing, token_counts
from chroniq.llm import queries as Q
from chroniq.llm.common import fold

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")

TRICKY = [
    "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>",
    "it's  they'll we x\x1cy\x85z",
    "é ́ ﬁ ÅÄ İ",
    "tab\t\ttab\r\n\r\nx\x0b\x0cy",
    "12345 67 ½ ²",
    "日本語 中文  العربية 🙂🙂",
    " " * 50,
    "x" * 3000,
    "don't!!??...###",
]


def rows_with_tricky():
    return base_rows() + [(500 + i, t) for i, t in enumerate(TRICKY)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library(spark, tmp_path, name):
    path, rows = public_tokenizers.path(name), rows_with_tricky()
    if name.endswith(".json"):
        tokenizer = Tokenizer.from_file(path)
        count = lambda t: len(tokenizer.encode(t, add_special_tokens=False))
    else:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    cache = str(tmp_path / "counts")
    got = token_counts.count_tokens(documents(spark, rows), path, cache, limit=100).collect()
    expected = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 100) for i, t in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(expected, key=repr)


def test_cache_encodes_only_what_is_new(spark, tmp_path):
    cache = str(tmp_path / "counts")
    first, more = base_rows(), [(900, "brand new"), (901, "brand  new\n"), (902, base_rows()[0][1])]
    count = lambda rows: token_counts.count_tokens(documents(spark, rows), WORD_BPE, cache).count()
    size = lambda: spark.read.parquet(cache).select("tokenizer", "content").distinct().count()
    assert count(first) == len(first)
    once = size()
    assert once == len({" ".join((t or "").split()) for _, t in first})
    count(first)
    assert size() == once
    count(first + more)
    assert size() == once + 1  # the two new texts differ in white space only
    token_counts.count_tokens(documents(spark, first), BYTE_BPE, cache).count()
    assert size() > once + 1  # another tokenizer shares no counts
    assert token_counts.count_tokens(documents(spark, []), WORD_BPE, cache).count() == 0


def test_repeated_rows_are_encoded_once(spark, tmp_path):
    """Rows equal in identifier and text, rows without an identifier and one text in most rows: one count is stored for each text."""
    cache = str(tmp_path / "counts")
    rows = [(1, "same row")] * 40 + [(None, "no name")] * 40 + [(None, "half"), (3, "half")] + [(i, "copy") for i in range(10, 400)] + [(5, ""), (6, None)]
    got = token_counts.count_tokens(documents(spark, rows).repartition(8), WORD_BPE, cache).collect()
    tokenizer = Tokenizer.from_file(WORD_BPE)
    expected = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids), False) for i, t in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(expected, key=repr)
    assert spark.read.parquet(cache).count() == 5


def check_pieces(pieces, rows, length=2048):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    wanted = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        wanted[(i, tuple(ids))] += 1
    by_window, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length > 0
        by_window[p.sequence_id].append((p.offset, p.length))
        by_doc[(p.doc_id, p.doc_tokens)].append((p.start, p.ids))
    for spans in by_window.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at <= length
    sizes = [sum(n for _, n in by_window[k]) for k in sorted(by_window)]
    assert sorted(by_window) == list(range(len(sizes))) and all(n == length for n in sizes[:-1])
    total = Counter()
    for i, ids in wanted:
        total[(i, len(ids))] += wanted[(i, ids)] * len(ids)
    assert {k: sum(len(ids) for _, ids in v) for k, v in by_doc.items()} == dict(total)
    for (i, ids), n in wanted.items():
        if sum(1 for j, other in wanted if (j, len(other)) == (i, len(ids))) == 1 and n == 1:
            whole = [t for _, piece in sorted(by_doc[(i, len(ids))]) for t in piece]
            assert whole == list(ids)


@pytest.mark.parametrize("weights", [None, {"src0": 3.0, "src1": 1.0}])
def test_packing_round_trip(spark, weights):
    rows = rows_with_tricky()
    pieces = packing.pack(documents(spark, rows).repartition(3), BYTE_BPE, weights=weights, with_ids=True, length=64).collect()
    check_pieces(pieces, rows, 64)


def test_packing_holds_the_mixture(spark):
    rows = [(i, prose(i, 50 + 40 * (i % 3))) for i in range(90)]
    pieces = packing.pack(documents(spark, rows).repartition(5), BYTE_BPE, length=256).collect()
    total = Counter()
    for p in pieces:
        total[p.source] += p.length
    share = {s: n / sum(total.values()) for s, n in total.items()}
    last = max(p.sequence_id for p in pieces)
    for window in range(last):
        got = Counter()
        for p in pieces:
            if p.sequence_id == window:
                got[p.source] += p.length
        assert all(abs(got[s] - 256 * share[s]) < 2 for s in share)


def test_packing_of_many_small_sources_and_of_nothing(spark):
    rows = [(i, prose(i, 5)) for i in range(1500)]
    docs = documents(spark, rows, clash=False).withColumn("source", F.concat(F.lit("s"), F.col("doc_id")))
    pieces = packing.pack(docs, BYTE_BPE, length=128, with_ids=True).collect()
    check_pieces(pieces, rows, 128)
    assert packing.pack(docs.limit(0), BYTE_BPE).count() == 0


def by_window(pieces):
    got = defaultdict(Counter)
    for p in pieces:
        got[p.sequence_id][p.source] += p.length
    return got


def test_packing_holds_small_sources_to_their_targets(spark):
    rows = [(i, prose(i, 60)) for i in range(120)]
    docs = documents(spark, rows, clash=False).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 40))
    pieces = packing.pack(docs.repartition(3), BYTE_BPE, length=32, with_ids=True).collect()
    check_pieces(pieces, rows, 32)
    total, so_far, got = Counter(), Counter(), by_window(pieces)
    for p in pieces:
        total[p.source] += p.length
    for window in sorted(got)[:-1]:
        so_far.update(got[window])
        assert all(abs(so_far[s] - 32 * (window + 1) * n / total.total()) < 4 for s, n in total.items())


def test_packing_gives_a_rare_source_its_weight(spark):
    rows = [(i, prose(i, 300)) for i in range(200)] + [(1000, "rare words")]
    docs = documents(spark, rows, clash=False).withColumn("source", F.when(F.col("doc_id") == 1000, "rare").otherwise("big"))
    pieces = packing.pack(docs, BYTE_BPE, length=8, weights={"big": 0.5, "rare": 0.5}, with_ids=True).collect()
    check_pieces(pieces, rows, 8)
    assert by_window(pieces)[0] == {"rare": min(4, next(p.doc_tokens for p in pieces if p.source == "rare")), "big": 4}


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(1, 5000), min_size=1), st.one_of(st.none(), st.dictionaries(st.sampled_from("abcdef"), st.floats(0, 9))))
def test_no_queue_takes_tokens_back(sizes, weights):
    schedule = packing.Schedule.plan(sizes, 7, weights)
    windows = np.arange(-(-schedule.total // 7))
    assert all((np.diff(schedule.given(q, windows)) >= 0).all() for q in range(len(sizes)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**13), min_size=1, max_size=20), st.integers(0, 10**14), st.integers(1, 10**14))
def test_mul_div(a, b, c):
    b = min(b, c)
    assert packing.mul_div(np.array(a), b, c).tolist() == [x * b // c for x in a]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(1, 5000), min_size=1), st.one_of(st.none(), st.dictionaries(st.sampled_from("abcdef"), st.floats(0, 9))))
def test_schedule_gives_each_queue_its_tokens(sizes, weights):
    schedule = packing.Schedule.plan(sizes, 64, weights)
    windows = np.arange(-(-schedule.total // 64))
    given_ = np.stack([schedule.given(q, windows) for q in range(len(sizes))])
    assert (np.diff(given_, axis=1) >= 0).all() or min(sizes.values()) * 64 < schedule.total or weights is not None
    assert given_[:, -1].tolist() == [sizes[n] for n in schedule.names]
    assert (given_.sum(0) == np.minimum((windows + 1) * 64, schedule.total)).all()


def brute_lm(rows):
    toks = [[w for w in (t or "").encode().lower().split()] + [b"\n"] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    c = Counter(w for ws, h in zip(toks, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return toks, held, c, n, v


@pytest.mark.parametrize("chunk", [1_000_000, 37])
def test_lm_counts_and_base_score(spark, monkeypatch, chunk):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(lm, "BUCKET_KEYS", 500)
    rows = rows_with_tricky()
    toks, held, c, n, v = brute_lm(rows)
    got = lm.score_texts(documents(spark, rows), fold("doc_id", 5) == 1).collect()
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    expected = [
        (i, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        for (i, _), ws, h in zip(rows, toks, held, strict=True)
    ]
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def test_lm_score_is_the_mixture_with_the_learned_weights(spark, monkeypatch):
    rows = [(i, prose(i % 7, 60) + " " + prose(i, 10)) for i in range(80)]
    kept = {}
    real = lm.mixture_weights
    monkeypatch.setattr(lm, "mixture_weights", lambda *a: kept.setdefault("w", real(*a)))
    got = {r.doc_id: r for r in lm.score_texts(documents(spark, rows), fold("doc_id", 5) == 1).collect()}
    toks, held, c, n, v = brute_lm(rows)
    pairs, heads = Counter(), Counter()
    for ws, h in zip(toks, held, strict=True):
        if not h:
            for a, b in zip([b"\t", *ws[:-1]], ws, strict=True):
                pairs[a, b] += 1
                heads[a] += 1
    for (i, _), ws in zip(rows, toks, strict=True):
        score = 0.0
        for a, b in zip([b"\t", *ws[:-1]], ws, strict=True):
            w = kept["w"][min(int(math.log2(heads[a] + 1)), lm.LEVELS)]
            score += math.log10(w[0] * pairs[a, b] / max(heads[a], 1) + w[1] * c[b] / n + w[2] / (v + 1))
        assert got[i].score == pytest.approx(score, rel=1e-9)
        if held[i]:
            assert got[i].score > got[i].base_score
    assert kept["w"].sum(1) == pytest.approx(np.ones(lm.LEVELS + 1))


def test_lm_without_training_rows_and_without_rows(spark):
    docs = documents(spark)
    assert all(r.n_known == 0 and r.score <= 0 for r in lm.score_texts(docs, F.lit(True)).collect())
    assert lm.score_texts(docs.limit(0), F.lit(False)).count() == 0


def test_mixture_weights_raise_the_likelihood():
    rng = np.random.default_rng(0)
    table = (3 * lm.CELLS + rng.integers(0, 40, 50)) * lm.CELLS + rng.integers(20, 80, 50)
    counts = rng.integers(1, 9, 50).astype(float)

    def likelihood(w):
        f = np.stack([2.0 ** (-(table // lm.CELLS % lm.CELLS) / 4), 2.0 ** (-(table % lm.CELLS) / 4), np.full(50, 1 / 101)])
        return (counts * np.log(w @ f)).sum()

    best = lm.mixture_weights(table, counts, 100)[3]
    assert likelihood(best) > likelihood(np.full(3, 1 / 3))


LICENSED = [
    (1, "Text.\nLicensed under the Apache License, Version 2.0."),
    (2, "cc  BY-nc\nall rights reserved all rights\nreserved General PUBLIC license cc by cc by"),
    (3, "licensed under the license version two of apache 2 0"),
    (4, "This work is licensed under the GNU General Public License, version 3." * 3),
    (5, "released under the license"),
    (6, "mit und mit released"),
    (7, "Released\nunder the MIT License"),
]


def brute_licenses(text, threshold=0.8):
    words = words_of(text)
    base = [
        (at, label) for label, p in license_scan.PHRASES.items() for at in range(len(words)) if words[at : at + len(p.split())] == p.split()
    ]
    shares = []
    for line in (text or "").split("\n"):
        for label, t in license_scan.TEMPLATES.items():
            wanted = set(words_of(t))
            share = len(wanted & set(words_of(line))) / len(wanted)
            if share >= threshold - 1e-12:
                shares.append((share, label))
    labels = {b for _, b in base}
    return (
        len(words), len(base), min((a for a, _ in base), default=None), max((a for a, _ in base), default=None), ",".join(sorted(labels)),
        ",".join(sorted(labels | {b for _, b in shares})), 1.0 if base else max((s for s, _ in shares), default=0.0),
    )


def test_license_scan_equals_brute_force(spark):
    rows = rows_with_tricky() + LICENSED
    got = license_scan.scan_licenses(documents(spark, rows)).drop("blocks").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *brute_licenses(t)) for i, t in rows], key=repr)
    assert license_scan.scan_licenses(documents(spark, [])).count() == 0


BSD_HEADER = "Copyright 1999\n\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that\n"
MPL_HEADER = "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy\n"


def brute_wrapped(text):
    *base, labels, score = brute_licenses(text)
    labels, shares = set(filter(None, labels.split(","))), [score]
    lines = [words_of(line) for line in (text or "").split("\n")]
    runs = [[]]
    for line in lines:
        runs = [*runs[:-1], runs[-1] + line] if line else [*runs, []]
    for run in runs:
        for label, t in license_scan.TEMPLATES.items():
            wanted, span = set(words_of(t)), 2 * len(words_of(t))
            share = max((len(wanted & set(run[i : i + span])) / len(wanted) for i in range(len(run))), default=0)
            if share >= 0.8 - 1e-12:
                labels.add(label)
                shares.append(share)
    return *base, ",".join(sorted(labels)), max(shares)


def test_wrapped_notices(spark):
    apart = "This work is licensed under\n\nthe GNU General Public License, version 3"
    far = "Released early\n" + prose(1, 30) + "\nunder the\n" + prose(2, 30) + "\nMIT License"
    rows = [(1, BSD_HEADER), (2, MPL_HEADER), (3, apart), (4, far), (5, "x\n" + "\n".join(license_scan.TEMPLATES["cc-by-nc-4.0"].split()))]
    for label, t in license_scan.TEMPLATES.items():
        for width in (1, 2, 3, 5, 8):
            w = t.split()
            rows.append((len(rows) + 10, prose(len(rows), 9) + "\n" + "\n".join(" ".join(w[i : i + width]) for i in range(0, len(w), width)) + "\n" + prose(0, 9)))
    got = license_scan.scan_licenses(documents(spark, rows), wrapped=True)
    found = {r.doc_id: r for r in got.collect()}
    assert [found[i].labels for i in (1, 2, 4, 5)] == ["bsd", "mpl-2.0", "", "cc-by,cc-by-nc-4.0"] and found[1].blocks[0].block == 2
    for i, t in rows:
        assert tuple(found[i])[1:-1] == brute_wrapped(t)


def test_registered_license_scan_finds_wrapped_notices(spark, tmp_path):
    documents(spark, [(1, BSD_HEADER), (2, MPL_HEADER)], clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.labels, r.score) for r in Q.op6_license_scan(spark, str(tmp_path)).collect()}
    assert got == {1: ("bsd", 1.0), 2: ("mpl-2.0", 1.0)}


def test_check_sql_says_what_the_license_scan_does(spark, tmp_path):
    """On notices on one line, wrapped at any width, damaged, parted by an empty line, doubled, and on tables of prose."""
    rows = [(1, BSD_HEADER), (2, MPL_HEADER), (3, None), (4, ""), (4, ""), (5, "\n\n\n")]
    for label, t in license_scan.TEMPLATES.items():
        w = t.split()
        for width in (1, 3, 8, len(w) // 2 + 1, len(w)):
            lines = [" ".join(w[i : i + width]) for i in range(0, len(w), width)]
            for text in ("\n".join(lines), "\n\n".join(lines), "\n".join(lines[1:]), "\n".join(lines[::2]), f"{prose(width, 9)}\n" + "\n".join(lines + lines)):
                rows.append((len(rows) + 10, f"{label[0]} x\n" + text + "\n" + prose(0, 5)))
    documents(spark, rows, clash=False).write.parquet(f"{tmp_path}/t")
    pq.write_table(pq.read_table(f"{tmp_path}/t"), f"{tmp_path}/documents.parquet")
    got = Q.op6_license_scan(spark, str(tmp_path))
    assert compare(got, connect(tmp_path), Q.ORACLES["op6_license_scan"]) is None
    assert {x for r in got.collect() for x in r.labels.split(",") if x} >= set(license_scan.TEMPLATES)


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.sampled_from("uvwxyz"), st.sets(st.sampled_from("abcdefgh"), min_size=1), min_size=1),
    st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 9)), st.lists(st.sampled_from("abcdefghijk"), max_size=12), st.sampled_from([0.3, 0.5, 0.8, 1.0]),
)
def test_index_misses_no_template(templates, lines, words, threshold):
    templates = {k: sorted(w.encode() for w in v) for k, v in templates.items()}
    lines, words = {k.encode(): n for k, n in lines.items()}, [w.encode() for w in words]
    index = license_scan.Index(templates, lines, threshold)
    expected = {k: len(set(v) & set(words)) / len(v) for k, v in templates.items() if len(set(v) & set(words)) >= threshold * len(v) - 1e-9 and set(v) & set(words)}
    assert dict(index.matches(words)) == expected
