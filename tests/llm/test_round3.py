"""SimHash fingerprints, token alignment and hard negatives against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from edge import base_rows, documents, prose
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chroniq.llm import hard_negatives, simhash, token_alignment
from chroniq.llm import queries as Q
from chroniq.llm.sql import OP13

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- fingerprints ---------------------------------------------------------------------------------------------------------


def expected_pairs(rows):
    """The contract, one document after the other."""
    import xxhash

    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode(), 42) - (1 << 64) * (xxhash.xxh64_intdigest((r[1] or "").encode(), 42) >> 63)))
    prints, out = simhash.SimHash(), []
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 2
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = prints(text), prints(edited), prints(following)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), simhash.likeness(a, b), simhash.likeness(a, c)))
    return out


FINGERPRINT_ROWS = base_rows() + [(-7, "ends 🙂🙂 beyond"), (99, "x" * 40_000), (100, "日本 語"), (12, "..."), (13, "a"), (14, "!?")]


@pytest.mark.parametrize("part_bytes", [simhash.PART_BYTES, 300])
def test_fingerprints_of_documents_and_edited_texts(spark, part_bytes):
    got = simhash.fingerprint_pairs(documents(spark, FINGERPRINT_ROWS), part_bytes=part_bytes)
    got = [(r.id, r.n_chars, r.edited_sha256, bytes(r.fingerprint).hex(), bytes(r.edited_fingerprint).hex(), r.near_edited, r.near_next) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(expected_pairs(FINGERPRINT_ROWS), key=repr)


def test_votes_are_those_of_the_definition():
    """A fingerprint's bits, from terms and weights one by one."""
    prints = simhash.SimHash(64)
    for text in (prose(3, 70), "one", "a b a b a", "...", ""):
        terms, weights = prints.terms(text)
        votes = [0] * 64
        for t, w in zip(terms, weights.tolist(), strict=True):
            h = int(simhash.mixed(np.array([t ^ prints.seeds[0]], np.uint64))[0])
            bits = "".join(f"{byte:08b}" for byte in h.to_bytes(8, "little"))
            votes = [v + (w if b == "1" else -w) for v, b in zip(votes, bits, strict=True)]
        expected = int("".join("1" if v > 0 else "0" for v in votes), 2)
        assert int.from_bytes(prints(text), "big") == expected
        words = text.lower().split() if text != "..." else []
        if words:
            counts = Counter(words) + Counter(zip(words, words[1:], strict=False))
            assert sorted(weights.tolist()) == sorted(int(np.rint(16 * (1 + np.log2(n)))) for n in counts.values())


def test_likeness_follows_shared_words():
    prints = simhash.SimHash()
    text, other = prose(1, 300), prose(2, 300)
    words, far = text.split(), [f"z{i}" for i in range(300)]
    alike = [simhash.likeness(prints(text), prints(" ".join(words[: 300 - k] + far[:k]))) for k in (0, 15, 75, 150, 300)]
    assert alike == sorted(alike, reverse=True) and alike[0] == 1.0 and alike[-1] < 0.2
    assert simhash.likeness(prints(text), prints(other)) < 0.9


@pytest.mark.parametrize(("bits", "radius", "blocks"), [(64, 3, 4), (64, 3, 6), (128, 5, 6), (256, 10, 11)])
def test_block_tables_find_all_pairs(spark, monkeypatch, bits, radius, blocks):
    monkeypatch.setattr(simhash, "SLICE", 16)  # buckets of several slices
    rng = random.Random(bits + blocks)
    prints = []
    for _ in range(12):
        base = rng.getrandbits(bits)
        for _ in range(rng.choice([1, 3, 40])):
            flips = sum(1 << b for b in rng.sample(range(bits), rng.randrange(radius + 3)))
            prints.append(base ^ flips)
    prints = [p.to_bytes(bits // 8, "big") for p in prints + prints[:5]]
    expected = {
        (a, b, d) for a, b in combinations(sorted(set(prints)), 2) if (d := (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()) <= radius
    }
    frame = spark.createDataFrame([(p,) for p in prints] + [(None,)], "fingerprint binary")
    got = [(bytes(r.a), bytes(r.b), r.distance) for r in simhash.near_pairs(frame, radius, blocks, bits).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    copies = Counter(prints)
    near = {p: n - 1 for p, n in copies.items()}
    for a, b, _ in expected:
        near[a] += copies[b]
        near[b] += copies[a]
    counted = {bytes(r.fingerprint): (r.n_copies, r.n_near) for r in simhash.near_counts(frame, radius, blocks, bits).collect()}
    assert counted == {p: (copies[p], near[p]) for p in copies}


def test_empty_tables_and_one_document(spark):
    assert simhash.document_fingerprints(documents(spark, [])).count() == 0
    one = simhash.document_fingerprints(documents(spark, [(3, "ab cd")])).first()
    assert (one.n_near, one.near_next, one.n_chars) == (0, 1.0, 5)
    files = (BYTES, PIECES)
    assert token_alignment.align(documents(spark, []), *files).documents().count() == 0
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(empty).count() == 0


# --- alignment of tokens --------------------------------------------------------------------------------------------------


def token_bytes():
    letters = {v: k for k, v in {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}.items()}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(letters.values()))}
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def of_a(i):
        return bytes(letters[c] for c in a.id_to_token(i))

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    return a, b, of_a, of_b


def expected_alignments(rows):
    a, b, of_a, of_b = token_bytes()
    docs, counts = [], Counter()
    for i, text in rows:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        bytes_a, bytes_b = [of_a(x) for x in ids_a], [of_b(x) for x in ids_b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            docs.append((i, [], [], [], []))
            continue
        ends = [np.cumsum([len(x) for x in bs]).tolist() for bs in (bytes_a, bytes_b)]
        links = [(x, y) for p, x in enumerate(ids_a) for q, y in enumerate(ids_b) if ends[0][p] == ends[1][q]] if len(ids_a) < 3000 else [
            (ids_a[ends[0].index(e)], ids_b[ends[1].index(e)]) for e in sorted(set(ends[0]) & set(ends[1]))
        ]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, low = [], 0
        for e in cuts:
            groups.append("|".join(",".join(str(x) for x, end in zip(ids, es, strict=True) if low < end <= e) for ids, es in ((ids_a, ends[0]), (ids_b, ends[1]))))
            low = e
        counts.update(links)
        docs.append((i, ids_a, ids_b, groups, links))
    highest = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for i, ids_a, ids_b, groups, links in docs:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else ""
        best = sum(counts[x] == highest[x[1]] for x in links)
        out.append((i, len(ids_a), len(ids_b), len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return out, counts, highest


ALIGNED_ROWS = base_rows()[:7] + base_rows()[8:] + [
    (50, "a<|endoftext|>b <s> </s> <unk> <0x41>"),
    (51, "it's  they'll\twe \r\n x\x1cy\x85z"),
    (52, "é ́ ﬁ ÅÄ İ 日本語 🙂🙂 ½"),
    (53, "under▁score"),
    (54, "  leading and trailing  "),
    (55, "12345 don't!!??... ###"),
    (56, "x" * 5000),
    (57, "\x00 nul"),
]


def test_alignment_equals_the_definition(spark):
    found = token_alignment.align(documents(spark, ALIGNED_ROWS), BYTES, PIECES)
    expected, counts, highest = expected_alignments(ALIGNED_ROWS)
    assert sorted(map(tuple, found.documents().collect()), key=repr) == sorted(expected, key=repr)
    assert sum(e[1] == 0 for e in expected) < len(expected) / 2  # most texts have tokens
    got = {(r.id_a, r.id_b): (r.n, r.best) for r in found.pair_counts().collect()}
    assert got == {k: (n, n == highest[k[1]]) for k, n in counts.items()}


def test_groups_join_to_the_text(spark):
    rows = [(1, prose(1, 30)), (2, "Ünï çödé ☃"), (3, None)]
    found = token_alignment.aligned_groups(documents(spark, rows), BYTES, PIECES).collect()
    a, b = token_alignment.ByteLevel(BYTES), token_alignment.Pieces(PIECES)
    for i, text in rows:
        groups = sorted((r for r in found if r.doc_id == i), key=lambda r: r.position)
        for ids, pieces in (("ids_a", a.pieces), ("ids_b", b.pieces)):
            assert b"".join(pieces[x] for g in groups for x in g[ids]) == (f" {text}".encode() if text else b"")
        assert [g.start for g in groups[1:]] == [g.end for g in groups[:-1]]


def test_all_pairs_that_can_be_linked_are_listed():
    a, b = [b"", b"ab", b"b", b"xab", b"c"], [b"ab", b"b", b"zb", b"", b"c"]
    expected = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x and y and (x.endswith(y) or y.endswith(x))}
    got = token_alignment.possible_pairs(a, b)
    assert {(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in got} == expected


# --- hard negatives ---------------------------------------------------------------------------------------------------------


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    for name in ("size", "code", "rank", "slot", "score", "anchor_id"):
        df = df.withColumn(name, F.lit("x"))
    return df


def expected_negatives(rows, every, scale=256, positives=5, negatives=3):
    whole = []
    for i, x, label in rows:
        if i is None or label is None or not x or any(v is None or not np.isfinite(v) for v in x):
            continue
        whole.append((i, label, [int(np.floor(v * scale)) for v in x]))
    out = []
    anchors = {}
    for i, label, x in whole:
        if i % every == 0:
            key = (label, len(x), np.array(x, "<f8").tobytes())
            anchors[i] = min(anchors.get(i, (key, x)), (key, x))
    for anchor, ((label, _, _), q) in anchors.items():
        scored = [(sum(a * b for a, b in zip(x, q, strict=True)), i, lab) for i, lab, x in whole if i != anchor and len(x) == len(q)]
        clipped = [(max(-hard_negatives.LONG, min(hard_negatives.LONG, s)), i, lab) for s, i, lab in scored]
        ranked = sorted(clipped, key=lambda r: (-r[0], r[1]))
        for p, pid, _ in [r for r in ranked if r[2] == label][:positives]:
            fit = [r for r in ranked if r[2] != label and 50 * p <= 100 * r[0] <= 95 * p][:negatives]
            out += [(anchor, pid, n, nid, p, s) for n, (s, nid, _) in enumerate(fit, 1)]
    return out


def awkward_vectors(seed, n, size):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, size))
    rows = []
    for i in range(n):
        x = centres[i % 4] * (0.3 + (i % 5) / 5) + rng.normal(size=size) * 0.2
        rows.append((i - 20, x.tolist(), int(rng.integers(3))))
    rows += [(900, [0.0] * size, 1), (950, [0.0] * size, 0), (901, None, 1), (902, [float("nan")] * size, 1), (903, [None] * size, 2), (904, [], 1)]
    rows += [(905, [1.0] * size, None), (None, [1.0] * size, 1), (906, [float("inf")] * size, 0), (1000, [0.5, 0.25], 1), (1001, [0.5, 0.5], 1), (1002, [0.4, 0.4], 2)]
    rows += [rows[3], rows[3], (0, rows[5][1], 2), (7, rows[9][1], 1), (8, rows[9][1], 1), (9, rows[9][1], 0), (10, rows[9][1], 0)]  # repeats and ties
    return rows


@pytest.mark.parametrize("size", [1, 16, 64])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, size):
    rows = awkward_vectors(size, 150, size)
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    found = hard_negatives.hard_negatives(vectors(spark, rows).repartition(3), every=10, anchor_bytes=20_000)
    got = [tuple(r)[:6] for r in found.collect()]
    assert sorted(got) == sorted(expected_negatives(rows, 10))
    assert got


def test_very_large_components(spark):
    rows = [(i, [float(v) * 2e7 for v in x], label) for i, x, label in awkward_vectors(5, 40, 3) if x and i is not None and None not in x and np.isfinite(x).all()]
    rows += [(2000, [1e30, 1.0, 0.0], 1), (2001, [2e30, 1.0, 0.0], 1), (2002, [1.5e30, 0.0, 0.0], 2)]
    got = [tuple(r)[:6] for r in hard_negatives.hard_negatives(vectors(spark, rows), every=10).collect()]
    assert sorted(got) == sorted(expected_negatives(rows, 10))


def test_intervals_hold_the_product():
    rng = np.random.default_rng(3)
    for size in (2, 17, 64):
        x = np.floor(rng.normal(size=(300, size)) * rng.choice([1, 50, 1000], size=(300, 1)))
        x[0], x[1] = 0, x[2]
        g = hard_negatives.frame(size)
        code, along, rest, reach = hard_negatives.encode(x, g)
        ones = np.bitwise_count(code).sum(1)
        for q in x[:20]:
            low, high = hard_negatives.Query(q, g).interval(code, ones, along, rest, reach)
            assert ((low <= x @ q) & (x @ q <= high)).all()
        # Of vectors in many dimensions the intervals rule out most.
        if size == 64:
            q = x[5]
            low, high = hard_negatives.Query(q, g).interval(code, ones, along, rest, reach)
            widest = 2 * np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum())
            assert ((high - low)[1:] < 0.35 * widest[1:]).all()


def coded(x, labels, rotations=2):
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(x))), pa.array(labels), pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(list(x))], ["vec_id", "label", "size", "vector"]
    )
    return pa.Table.from_batches(hard_negatives._coder(rotations)([batch])).combine_chunks().to_batches()


def test_a_row_is_scored_once_for_all_windows_of_an_anchor(monkeypatch):
    rng = np.random.default_rng(11)
    x, labels = np.floor(rng.normal(size=(400, 8)) * 20_000), rng.integers(0, 3, 400)
    anchors = [(int(i), int(labels[i]), x[i], [(-(2**40), int(1e9) + 1000 * w) for w in range(5)]) for i in range(0, 400, 100)]
    seen, products = [], hard_negatives.products
    monkeypatch.setattr(hard_negatives, "products", lambda rows, q, *more: seen.extend((q.tobytes(), r.tobytes()) for r in rows) or products(rows, q, *more))
    found = next(hard_negatives._scanner(SimpleNamespace(value=anchors), 2, 3, True)(coded(x, labels))).to_pylist()
    assert seen
    assert len(seen) == len(set(seen))
    expected = set()
    for i, label, q, windows in anchors:
        for slot, (low, high) in enumerate(windows):
            fit = sorted((-int(s), j) for j, s in enumerate(x @ q) if labels[j] != label and low <= s <= high)[:3]
            expected |= {(i, slot, j, -s) for s, j in fit}
    assert {(r["anchor_id"], r["slot"], r["vec_id"], r["score"]) for r in found} == expected


def test_rotations_are_made_once_for_a_size(monkeypatch):
    made, frame = [], hard_negatives.frame
    monkeypatch.setattr(hard_negatives, "frame", lambda size, rotations: made.append(size) or frame(size, rotations))
    rows = 3 * 4096
    coded(np.ones((rows, 4)), np.zeros(rows, np.int64))
    assert made == [4]


@pytest.mark.parametrize("scale", [1, 256, 2**12, 2**24, 2**40, 1e290])
def test_products_are_exact_at_any_magnitude(scale):
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(50, 16)) * scale)
    x[:5] = 0
    part = coded(x, np.zeros(50, np.int64))[0]
    block = hard_negatives.Block(part, 16)
    for q in (x[7], x[0], np.full(16, 1e200), np.ones(16)):
        for rows in (np.arange(5), np.arange(50)):
            got = block.scores(rows, q).tolist()
            whole = [sum(int(a) * int(b) for a, b in zip(r, q, strict=True)) for r in x[rows].tolist()]
            assert got == [max(-hard_negatives.LONG, min(hard_negatives.LONG, v)) for v in whole]


def test_registered_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(Q.op13_hard_negatives(spark, sf_dir), connect(sf_dir), OP13) is None
