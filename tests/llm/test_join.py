"""N-gram join, components and decontamination against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from edge import base_rows, documents, prose, shingles, words_of
from pyspark.sql import functions as F

from chroniq.llm import decontaminate, ngram_join
from chroniq.llm.components import components


def brute_classes(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])] for i in range(n)]
    copies = [sum(words_of(rows[i][1]) == words_of(t) for _, t in rows) if sets[i] else 1 for i in range(n)]
    seen, out = {}, []
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        for j in group:
            seen[j] = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
    for i, (name, _) in enumerate(rows):
        out.append((name, seen[i], copies[i], len(linked[i])))
    return sorted(out, key=repr)


def spark_classes(df, **options):
    found = ngram_join.similarity_classes(df, **options)
    return sorted(((r.doc_id, r.class_id, r.n_copies, r.n_links) for r in found.collect()), key=repr)


def crowd():
    """A large group of near copies that all differ, pairs at the edge of the threshold, and texts that share a passage."""
    rng, rows = random.Random(5), []
    base = prose(77, 80).split()
    for i in range(60):
        words = list(base)
        words[rng.randrange(80)] = f"new{i}"
        rows.append((100 + i, " ".join(words)))
    passage = prose(78, 60)
    rows += [(200 + i, prose(300 + i, 60) + " " + passage) for i in range(20)]
    return rows


def test_classes_equal_brute_force_on_awkward_rows(spark):
    assert spark_classes(documents(spark)) == brute_classes(base_rows())


@pytest.mark.parametrize("block", [1000, 16])
def test_classes_of_a_crowd_in_one_block_or_many(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "NODE_BLOCK", block)
    monkeypatch.setattr(ngram_join, "SET_BLOCK", block)
    rows = crowd()
    assert spark_classes(documents(spark, rows)) == brute_classes(rows)


def test_one_of_each(spark):
    rows = base_rows()
    docs = documents(spark, rows)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    texts = dict(((i, t), None) for i, t in rows)
    expected = [(i, t) for i, t in texts if (i, t) not in {(2, rows[1][1]), (3, rows[2][1]), (10, "two words")}]
    assert got == sorted(expected, key=repr)


def test_empty_table(spark):
    empty = documents(spark, [])
    assert spark_classes(empty) == []
    assert ngram_join.one_of_each(empty).count() == 0


def test_prefix_is_the_longest_that_reaches_the_recall():
    k = ngram_join.prefix_length(0.8, 20, 6, 0.9999)
    found = lambda k: 1 - (1 - 0.8**k) ** 20
    assert found(k) >= 0.9999 > found(k + 1)


def test_equal_rows_send_one_text(spark, tmp_path):
    rows = [(1, prose(50, 40))] * 3000 + [(2, prose(50, 40)), (3, prose(51, 40)), (3, prose(51, 40))]
    texts = documents(spark, rows).select("doc_id", F.encode("text", "utf-8").alias("text")).withColumn("row", F.xxhash64("doc_id"))
    members = texts.select("row", F.lit("group").alias("group")).where("row <> xxhash64(2L)").distinct()
    held = ngram_join.one_text_each(texts.select("row", "text"), members, texts, str(tmp_path))
    assert sorted(bytes(r.text).decode() for r in held.collect()) == sorted({prose(50, 40), prose(51, 40)})


def test_repeated_rows_in_a_class_equal_brute_force(spark):
    near = prose(50, 80).replace(" ", "  ", 3) + " end"
    rows = [(1, prose(50, 80))] * 40 + [(2, near)] * 3 + [(4, prose(51, 80))] * 2
    assert spark_classes(documents(spark, rows)) == brute_classes(rows)


def signature_rows(spark, signatures):
    rows = [(bytes([i]), bytearray(np.asarray(s, ">u2").tobytes())) for i, s in enumerate(signatures)]
    return spark.createDataFrame(rows, "text_key binary, signature binary")


def test_prefixes_are_shortened_until_texts_meet(spark, tmp_path):
    rng = np.random.default_rng(3)
    base, other = rng.integers(0, 60000, (2, 20, 6))
    fifth, third = base.copy(), base.copy()
    fifth[:, 4] += 1  # shares four hashes of every tree with the base, and 100 of 120 in all
    third[:, 2] += 1  # shares two of every tree: above what a pair at the threshold needs
    distinct = signature_rows(spark, [s.ravel() for s in (base, fifth, third, other)])
    found = ngram_join.forest_ties(distinct, str(tmp_path), 0.8, 20, 6, 0.9999).collect()
    assert {(r.a[0], r.b[0]) for r in found} in ({(0, 1)}, {(1, 0)})


def test_equal_signatures_are_one_leaf_and_stay_tied(spark, tmp_path):
    one, two = np.random.default_rng(4).integers(0, 60000, (2, 120))
    found = ngram_join.forest_ties(signature_rows(spark, [one, two, one, one]), str(tmp_path), 0.8, 20, 6, 0.9999).collect()
    assert {(r.a[0], r.b[0]) for r in found} == {(0, 2), (0, 3)}


def test_only_texts_with_near_partners_are_settled(spark):
    leaves = spark.createDataFrame([(k.encode(), b"s", True) for k in "abcde"], "leaf binary, signature binary, open boolean")
    met = spark.createDataFrame([(b"a", b"b", 119), (b"c", b"d", 92), (b"c", b"a", 118)], "a binary, b binary, agree int")
    left = ngram_join.settle(leaves, met, 20, 120, 6, 0.9999).collect()
    assert {bytes(r.leaf).decode(): r.open for r in left} == {"a": False, "b": False, "c": True, "d": True, "e": True}


def test_recall_of_links_at_the_threshold(spark):
    """Pairs of texts just above the threshold, of which the forest may miss few."""
    rng, rows = random.Random(9), []
    for i in range(300):
        words = prose(5000 + i, 104).split()
        rows.append((2 * i, " ".join(words)))
        rows.append((2 * i + 1, " ".join([*words[: -rng.randrange(12, 19)]])))
    got = {r[0]: r[3] for r in spark_classes(documents(spark, rows))}
    links = {name: n for name, _, _, n in brute_classes(rows)}
    assert sum(links.values()) > 400
    assert sum(got.values()) >= 0.99 * sum(links.values())
    assert all(got[i] <= links[i] for i in links)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 200), (201, 202), (202, 201)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.vertex: r.component for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 201: 201, 202: 201}
    assert components(df.limit(0)).count() == 0


def test_intersections_are_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (0, 5, 100, 250, 250)]
    got = ngram_join.intersections([s for s in sets], columns=16)
    assert got.tolist() == [[len(np.intersect1d(a, b)) if i != j or len(a) else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)] or all(
        got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(5) for j in range(5) if i != j
    )


ITEMS = [(1, prose(900, 30)), (2, prose(901, 14)), (3, "one two three"), (4, None), (5, ""), (None, prose(902, 59)), (1, prose(900, 30)), (6, prose(903, 700))]


def contaminated():
    long = [prose(i, 400) for i in range(20)]
    return [
        (1, prose(10, 50)),
        (2, " ".join([*long, ITEMS[0][1], *long])),
        (3, prose(11, 3000) + " " + ITEMS[1][1] + " " + prose(12, 3000) + "\n" + ITEMS[5][1]),
        (4, "One, two: THREE!"),
        (5, "zero one two three four"),
        (6, " ".join(ITEMS[0][1].split()[:20])),  # too little of it
        (7, " ".join(ITEMS[0][1].split()[:27]) + " x " + prose(13, 9)),
        (8, ITEMS[7][1] + " end"),
        (None, ITEMS[1][1]),
        (9, None),
        (10, ""),
        (2, "another row of two"),
    ]


def brute_items(rows, items):
    out = []
    for name, text in rows:
        held = shingles(text)
        for item, wanted in ((i, shingles(t)) for i, t in items):
            both = len(held & wanted)
            if wanted and both >= 0.8 * len(wanted):
                out.append((name, item, len(wanted), both))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_bytes", [1 << 24, 6000])
def test_items_equal_brute_force(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part_bytes)
    docs = documents(spark, contaminated() + base_rows())
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.find_items(docs, items).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_item_shingles, r.n_found) for r in got), key=repr) == brute_items(contaminated() + base_rows(), ITEMS)
    assert all(r.containment == r.n_found / r.n_item_shingles for r in got)


def test_items_of_few_shingles_in_long_texts(spark):
    items = [
        (1, "same " * 300), (2, "a rather short item here"), (3, "only four words there"), (4, "red green blue " * 90),
        (5, prose(950, 6)), (6, prose(951, 7)), (7, prose(952, 60) + " tail" * 240), (8, prose(953, 25)),
    ]
    rows = [(i, f"{prose(1000 + i, 3000)} {items[i % 8][1]} {prose(2000 + i, 3000)}") for i in range(48)]
    rows += [(90, items[2][1]), (91, "same " * 4), (92, "red green blue red green blue red"), (93, prose(952, 45) + " tail" * 9)]
    # Alone, an item is looked for in the windows of its own size only.
    for few in (items, [items[0], items[3]]):
        got = decontaminate.find_items(documents(spark, rows), spark.createDataFrame(few, "item_id bigint, text string")).collect()
        expected = brute_items(rows, few)
        assert len({name for name, *_ in expected}) >= 12
        assert sorted(((r.doc_id, r.item_id, r.n_item_shingles, r.n_found) for r in got), key=repr) == expected


def test_no_five_word_item_is_missed(spark):
    items = [(i, f"a rather short item {i}") for i in range(3000)]
    rows = [(i, f"{prose(i, 40)} {item} {prose(9000 + i, 40)}") for i, item in items]
    got = decontaminate.find_items(documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, i) for i, _ in items]


def test_decontaminate_drops_rows_not_identifiers(spark):
    docs = documents(spark, contaminated())
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontaminate.decontaminate(docs, items)
    hit = defaultdict(int)
    for name, *_ in brute_items(contaminated(), ITEMS):
        hit[name] += 1
    expected = [(i, t) for i, t in contaminated() if not brute_items([(i, t)], ITEMS)]
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_items_without_items_or_documents(spark):
    docs, items = documents(spark), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.find_items(docs, items.limit(0)).count() == 0
    assert decontaminate.find_items(docs.limit(0), items).count() == 0
    assert decontaminate.find_items(docs, items.where("item_id = 5")).count() == 0
