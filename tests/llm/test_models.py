"""Classifiers, address filter and vector search against plain versions and held-out labels."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import base_rows, documents, prose
from pyspark.sql import functions as F

from chroniq.llm import mtree, quality, toxicity, url_filter
from chroniq.llm import queries as Q

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(2)
    field = quality.Field(rng.normal(0, 1, 3 * quality.SLOTS), rng.normal(0, 1, 2), rng.normal(0, 1, (2, 2)))
    counts = np.array([3, 1, 5])
    numbers = rng.integers(0, 3 * quality.SLOTS, (9, 4))
    good, expected, heads, z = field.marginals(numbers, counts, pairs=True)
    moves, at, norm = np.zeros((2, 2)), 0, 0.0
    for n in counts:
        u = field.line[numbers[at : at + n]].sum(1)
        weight = {p: math.exp(field.start[p[0]] + sum(u[t] * p[t] for t in range(n)) + sum(field.move[a, b] for a, b in itertools.pairwise(p))) for p in itertools.product((0, 1), repeat=int(n))}
        total = sum(weight.values())
        norm += math.log(total)
        for t in range(n):
            assert good[at + t] == pytest.approx(sum(w for p, w in weight.items() if p[t]) / total)
        for p, w in weight.items():
            for a, b in itertools.pairwise(p):
                moves[a, b] += w / total
        at += n
    assert expected == pytest.approx(moves) and z == pytest.approx(norm) and heads.tolist() == good[[0, 3, 4]].tolist()


@pytest.mark.parametrize(("name", "label", "least"), [("op3_toxicity", "toxic", 0.9), ("op5_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    rows = Q.QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    fold = {"op3_toxicity": (5, 0), "op5_quality": (4, 2)}[name]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r[label] for r in held) >= least * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_classifiers_on_awkward_rows_and_without_labels(spark):
    docs, labels = documents(spark), spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, 1, 1), (99, 0, 0), (8, None, None)], "doc_id bigint, quality int, toxic int")
    n = len(base_rows())
    for some in (labels, labels.limit(0)):
        field = quality.learn(docs, some, F.lit(True))
        machine = toxicity.learn(docs, some, F.lit(True))
        for scored in (quality.score_quality(docs, field, F.lit(False)), toxicity.score_toxicity(docs, machine, F.lit(False))):
            rows = scored.collect()
            assert len(rows) == n and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
            empty = {round(r.score, 12) for r in rows if r.doc_id in (5, 6)}
            assert len(empty) == 1  # null is empty
        assert quality.score_quality(docs.limit(0), field, F.lit(False)).count() == 0
        assert toxicity.score_toxicity(docs.limit(0), machine, F.lit(False)).count() == 0


def test_quality_of_a_very_long_text_in_pieces(monkeypatch):
    lines = [prose(i, 30).encode() for i in range(200)]
    whole = quality.kind_counts(lines)
    monkeypatch.setattr(quality, "GROUP_BYTES", 500)
    assert (quality.kind_counts(lines) == whole).all()


def test_machine_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    m = toxicity.Machine({}, 0.3, rng.normal(0, 1, 6), rng.normal(0, 1, (6, 3)))
    terms = [0, 2, 5, 1]
    s = 0.3 + sum(m.linear[t] for t in terms) + sum(m.factors[a] @ m.factors[b] for a, b in itertools.combinations(terms, 2))
    assert m.scores(np.zeros(4, int), np.array(terms), 2) == pytest.approx([1 / (1 + math.exp(-s)), 1 / (1 + math.exp(-0.3))])


def test_machine_learns_an_interaction():
    """Neither term alone is toxic, both together are: no additive weights can say so."""
    docs = [[0], [1], [0, 1], []] * 50
    rows = np.repeat(np.arange(200), [len(d) for d in docs])
    terms = np.array([t for d in docs for t in d])
    labels = np.array([float(d == [0, 1]) for d in docs])
    m = toxicity.fit({0: 0, 1: 1}, rows, terms, labels, rounds=400)
    assert ((m.scores(rows, terms, 200) >= 0.5) == labels).all()


def test_host_path_and_longest_rule(spark):
    cases = [
        ("http://A.B.Net/x?y#z", "a.b.net", "/x", "net/", "block"),
        ("https://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
        ("https://m.example.net/en", "m.example.net", "/en", "net/", "block"),
        ("x://net", "net", "", None, None),
        ("ftp://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
        ("http://www.example.com/de/a://b", "www.example.com", "/de/a://b", "example.com/de/", "block"),
        ("http://w.org/fr/?q", "w.org", "/fr/", "org/fr/", "allow"),
        ("http://h.com?x/y", "h.com", "", None, None),
        ("no scheme", "", "", None, None),
        ("", "", "", None, None),
        (None, "", "", None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, url string")
    host, path = url_filter.parts(F.col("url"))
    rule = url_filter.rule_of(F.col("h"), F.col("p"), url_filter.RULES)
    got = df.select("i", host.alias("h"), path.alias("p")).select("i", "h", "p", rule.alias("r")).orderBy("i").collect()
    assert [(r.h, r.p, r.r and r.r.rule, r.r and r.r.verdict) for r in got] == [c[1:] for c in cases]


def test_best_split_is_the_likeliest():
    counts, total = {"casino": 9, "win": 20, "in": 50, "wi": 1, "s": 3, "casinos": 1}, 83
    name = "casinoswin"
    pieces = {(a, b - a): counts[name[a:b]] for a in range(10) for b in range(a + 1, 11) if name[a:b] in counts}

    def cost(words):
        return sum(-math.log(counts[w] / total) if w in counts else math.log(total) + (len(w) - 1) * math.log(10) for w in words)

    cuts = [[name[i:j] for i, j in itertools.pairwise([0, *c, 10])] for n in range(10) for c in itertools.combinations(range(1, 10), n)]
    assert cost(url_filter.best_split(name, pieces, total)) == pytest.approx(min(map(cost, cuts)))


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("x")).withColumn("uid", F.lit(1)).withColumn("words", F.lit("x"))


def test_address_verdicts(spark):
    rows = [(i, f"http://site{'abc'[i % 3]}.example.com/en/{i}", "<p>good plain casino win words</p>") for i in range(60)]
    rows += [(100 + i, f"http://casino-win.example.com/en/{i}", "<b>win</b>") for i in range(20)]
    rows += [(200, "http://casinowin.example.com/en/7", None), (201, "http://m.win.example.com/en/1", None), (202, None, None), (None, "http://x.net/", ""), (202, None, None)]
    got = {(r.page_id, r.host): r for r in url_filter.judge(pages(spark, rows), block_words=["casino"]).collect()}
    assert url_filter.judge(pages(spark, rows)).count() == len(rows)
    assert got[200, "casinowin.example.com"].words[:2] == ["casino", "win"] and got[200, "casinowin.example.com"].verdict == "block"
    assert got[201, "m.win.example.com"].verdict == "block"  # learned, not listed
    assert got[0, "sitea.example.com"].verdict == "allow" and got[202, ""].verdict == "allow"
    assert got[None, "x.net"].verdict == "block" and got[None, "x.net"].rule == "net/"
    assert url_filter.judge(pages(spark, rows[:60])).where("verdict = 'block'").count() == 0
    assert url_filter.judge(pages(spark, [])).count() == 0


def brute_verdicts(rows, rules=url_filter.RULES):
    """Every column of :func:`url_filter.judge`, by plain Python over all rows."""
    low = str.maketrans(url_filter.UPPER, url_filter.LOWER)
    letter = re.compile("[^\\x00-\\x60\\x7B-\\x7F]+")
    counts, parsed = Counter(), []
    for page, url, html in rows:
        m = re.search("://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(low), m[2]) if m else ("", "")
        path_words = ["0" if re.fullmatch("[0-9]+", w) else w for w in re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", path.translate(low))]
        counts.update(letter.findall(re.sub("<[^>]*>", " ", html or "").translate(low)) + path_words)
        counts.update(re.findall("[a-z]+(?=-)|(?<=-)[a-z]+", host))
        parsed.append((page, host, path, path_words))
    total = max(sum(counts.values()), 1)

    def split(name):
        best = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            costs = []
            for start in range(end):
                n = counts[name[start:end]]
                costs.append((round(best[start][0] + (-math.log(n / total) if n else math.log(total) + (end - start - 1) * math.log(10)), 9), start))
            best.append(min(costs))
        words, end = [], len(name)
        while end:
            words.insert(0, name[best[end][1] : end])
            end = best[end][1]
        return words

    told = []
    for page, host, path, path_words in parsed:
        words = [w for name in letter.findall(re.sub("[.][^.]*$", "", host)) for w in split(name)]
        words += ["." + host.rsplit(".", 1)[1]] if "." in host and host.rsplit(".", 1)[1] else []
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, None))
        told.append((page, host, path, rule, verdict, words + path_words))
    bad, good = (Counter(w for t in told if t[4] == v for w in t[5]) for v in ("block", "allow"))
    n_bad, n_good = (sum(t[4] == v for t in told) for v in ("block", "allow"))
    types, out = len(bad | good), []
    for page, host, path, rule, verdict, words in told:
        odds = math.log((n_bad + 1) / (n_good + 1))
        for w in words:
            if w in bad or w in good:
                odds += math.log((bad[w] + 1) / (bad.total() + types + 1)) - math.log((good[w] + 1) / (good.total() + types + 1))
        method = "block" if odds > 0 and n_bad else "allow"
        out.append((page, host, path, rule, verdict or method, words, round(odds, 6)))
    return sorted(out, key=repr)


def verdicts(df):
    return sorted(((*r[:5], r.words, round(r.log_odds, 6)) for r in df.collect()), key=repr)


def test_all_columns_of_verdicts_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()]
    long = "donaudampfschifffahrtskapitaen"
    rows += [
        (900, f"http://{long}.example.org/en/1", f"<p>{long} und {long}sohn</p>"), (901, f"http://{long}sohn.shop.example.com/es/", None),
        (902, "http://" + "ab" * 400 + ".example.org/x", ""), (903, "http://пример日本.example.net/en/ж", "<p>пример 日本 日本</p>"),
        (904, None, None), (904, None, None), (None, "HTTP://A-B.Example.NET/En", "a"), (905, "x://", "<b>"), (906, "http://./p", "q"),
    ]
    got = verdicts(url_filter.judge(pages(spark, rows)))
    assert got == brute_verdicts(rows)
    words = {r[0]: r[5] for r in got}
    assert words[900][0] == long and words[901][0] == f"{long}sohn"  # words of any length are known
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def brute_top(rows, k=5):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in {i: min(v for j, v in sound if j == i) for i, _ in sound if i % 50 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in sound if i != q and len(x) == len(y))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 0.3, (5, 8))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.05, 8)).tolist()) for i in range(600)]
    rows += [(600 + i, rows[0][1]) for i in range(90)]  # equal vectors: ties
    rows += [(1000, None), (1050, []), (1100, [1.0] * 7 + [None]), (1150, [float("nan")] * 8), (1200, [float("inf")] * 8), (None, rows[1][1])]
    rows += [(1250, [0.5, 0.25]), (1251, [0.5, -0.25]), (1300, [0.0] * 8), (50, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("tree", F.lit("x")).withColumn("vector", F.lit(1))
    got = mtree.top_k(df).drop("computed").collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows)
    assert mtree.top_k(df.limit(0)).count() == 0


def test_trees_are_whole_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(mtree, "CELL_ROWS", 300)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 0.4, 6).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert sorted(tuple(r) for r in mtree.top_k(df).drop("computed").collect()) == brute_top(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_routing_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", 40)
    monkeypatch.setattr(mtree, "ROOTS", 3)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.4, 6).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(tuple(r) for r in mtree.top_k(df).drop("computed").collect()) == brute_top(rows)


def test_a_tree_of_many_pages_prunes_and_is_exact():
    rng = np.random.default_rng(7)
    x = np.rint(rng.normal(0, 60, (40, 1, 16)) + rng.normal(0, 5, (40, 50, 16))).astype(np.int64).reshape(-1, 16)
    m = int((x**2).sum(1).max())
    names = [c.split()[0] for c in mtree.NODES.split(", ")]
    pages_ = mtree.build("t", np.arange(2000), x, m)
    reach = float(mtree.distances(mtree.lifted(x, m), mtree.lifted(x[:1], m)[0]).max())
    pages_.append(("t", -1, False, [], [0], [reach], [0.0], x[:1].astype("<i8").tobytes(), 1))
    tree = mtree.Tree([dict(zip(names, p, strict=True)) for p in pages_], m)
    asked = np.arange(0, 2000, 100)
    scores, ids, computed = tree.search(asked, x[asked], 5, np.full(len(asked), -np.inf))
    for n, q in enumerate(asked.tolist()):
        order = sorted(((int(s), -i) for i, s in enumerate(x @ x[q]) if i != q), reverse=True)[:5]
        assert list(zip(scores[n].tolist(), (-ids[n]).tolist(), strict=True)) == order
    assert computed.sum() < 20 * 2000 * 0.8


def test_very_large_components_and_many_equal_rows(spark, monkeypatch):
    """Products and squares beyond 64 bits, and one row that is there more often than a tree has rows."""
    monkeypatch.setattr(mtree, "TREE_ROWS", 50)
    monkeypatch.setattr(mtree, "PART_QUERIES", 4)
    monkeypatch.setattr(mtree, "BLOCK", 3)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(0, 1, 4) * (2e7 if i % 3 else 1)).tolist()) for i in range(1, 300)]
    rows += [(301, rows[0][1])] * 200 + [(350, rows[2][1]), (400, [1e17, 0.0, 0.0, -1e17]), (401, [1e17, 1.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    held = 2**63 - 1
    hold = lambda v: max(-held, min(held, v))
    sound = [(i, [hold(math.floor(256 * x)) for x in v]) for i, v in rows]
    expected = []
    for q, x in sound:
        if q % 50 == 0:
            scores = sorted((-hold(sum(a * b for a, b in zip(x, y, strict=True))), i) for i, y in sound if i != q)
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert sorted(tuple(r) for r in mtree.top_k(df).drop("computed").collect()) == sorted(expected)


def test_samples_are_bounded_whatever_is_repeated(spark):
    """Identifiers that come again, with the same text and with others, do not enlarge a sample."""
    rows = [(i % 40, f"text {i % 120}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (3, 1), (None, 1), (99, 1)], "doc_id bigint, toxic int")
    for n in (10, 100):
        sample = quality.labelled_sample(docs, labels, "toxic", F.lit(True), n, "doc_id", "text").collect()
        assert len(sample) <= min(n, 42)
    texts = {i: {t for j, t in rows if j == i} for i in range(40)}
    assert all(any(bytes(r.text).decode() in texts[i] for i in range(40)) for r in sample) and len(sample) == 42
