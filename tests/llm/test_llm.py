"""The llm operators against brute force, and on nulls, empty and long texts, ties, repeated rows and empty tables."""

import collections
import glob
import hashlib
import os
import re

import duckdb
import numpy as np
import pytest

from __spark_entry__ import oracle_sql, queries
from tidepanel.llm import html, licences, lines, neardup, packing, quality, repeats, toxicity
from tidepanel.llm.exact import displaced, exact_dedup
from tidepanel.llm.mixing import mix, mixed_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, doc string, node string"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, BASE), (2, BASE), (3, None), (4, ""), (5, " \n\t "), (6, "short"), (None, BASE + " tail"), (7, "x " * 30_000),
        (8, "A line that is long enough to count as a block of words\nnext\n" + BASE), (8, "again under one id"), (9, BASE.upper()),
        (2, BASE),
    ]
    return spark.createDataFrame([(i, t, None, None if (i or 0) % 2 else "s", None, "c", "d", "n") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts(sf):
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())


OPERATORS = {
    "licences": licences.scan, "quality": quality.judged, "neardup": neardup.classes, "lines": lines.dedup_lines, "mix": mix,
    "repeats": repeats.remove_repeats, "exact": lambda d: exact_dedup(d, d.limit(0)), "exact_known": lambda d: exact_dedup(d, d),
    "packing": packing.pack,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(odd, name):
    out = OPERATORS[name](odd).collect()
    if name == "packing":
        assert sum(r["piece"] == 0 for r in out) == odd.count() and max(r["length"] for r in out) <= packing.SIZE
    else:
        assert len(out) == odd.count()
    assert OPERATORS[name](odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op1_licence_scan", "op2_quality_rules", "op6_mix_sources", "op8_exact_dedup"])
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = queries()[name](spark, sf)
    columns = sorted(df.columns)
    cursor = con.execute(oracle_sql()[name])
    at = [d[0] for d in cursor.description]
    assert sorted(at) == columns
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(
        repr(tuple(r[at.index(c)] for c in columns)) for r in cursor.fetchall()
    )


def test_licences(spark):
    mit = next(t for k, t in licences.KNOWN if k == "MIT")
    rows = [(1, mit.upper().replace("License", "Licence") + "\nCopyright (c) 2001 Someone\n"), (2, "Prose.\nReleased under the MIT licence"), (3, "x")]
    got = {r["doc_id"]: (r["licence"], r["notices"]) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1][0] == "MIT" and got[2] == (None, "MIT") and got[3] == (None, "")


def test_near_duplicates_equal_brute_force(spark, sf, texts):
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, t in texts.items() if (w := (t or "").lower().split())}
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r["doc_id"]: r["class_id"] for r in queries()["op3_minhash_near_dedup"](spark, sf).collect()}
    assert got == {k: find(k) for k in texts}


def test_near_copies_of_near_copies_are_one_class(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[: i] + ["odd"] + words[i + 1 :])) for i in range(40)] + [(99, " ".join(f"v{i}" for i in range(200)))]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(40)} == {0} and got[99] == 99


def test_prefix_filter_finds_the_same_pairs(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words[:150] + [f"x{i // 4}_{k}" for k in range(150 - i % 4)])) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(r["doc_id"], r["class_id"]) for r in neardup.classes(docs).collect()}
    monkeypatch.setattr(neardup, "FEW", 0)
    assert {(r["doc_id"], r["class_id"]) for r in neardup.classes(docs).collect()} == want


def test_toxicity_learns_from_other_folds_only(spark, sf):
    docs = [(i, f"plain words number {i} " + ("you idiot moron" if i % 3 == 0 else "kind regards")) for i in range(400)] + [(None, None)]
    labels = [(i, int(i % 3 == 0)) for i in range(400)] + [(None, 1), (9999, None)]
    out = toxicity.scores(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    ).collect()
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None]
    assert len(out) == 401 and len(held) > 40
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.scores(spark.createDataFrame(docs, "doc_id long, text string"), none).count() == 401


def test_line_dedup(spark):
    a, b = "one two three four five six seven eight nine ten eleven", "red orange yellow green blue indigo violet black white grey pink"
    rows = [(1, f"{a}\n{b}"), (2, f"own start\n{a}\n{b}\nown end"), (3, "short\nlines"), (4, "short\nlines"), (5, f"{b}\n{a}")]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[2] == "own start\nown end"
    assert got[3] == got[4] == "short\nlines"  # too few words for a block
    assert got[5] in (a, b)  # crossing lines: one of them is aligned
    assert lines.patience([1, 2, 3, 4], [2, 9, 3, 4]) == [(1, 0), (2, 2), (3, 3)]


def test_mixing_takes_epochs_then_a_fraction(spark):
    rows = [(i, "word " * 10, "a") for i in range(100)] + [(100 + i, "word " * 10, "b") for i in range(100)] + [(300, "w", None), (300, "w", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix(docs).collect()
    taken = collections.Counter()
    for r in out:
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    goals = {r["source"]: r["target"] for r in out}
    assert goals[None] == 6.0 and sum(goals.values()) == pytest.approx(2002)
    assert all(abs(taken[s] - goals[s]) <= 10 for s in goals)
    assert mixed_rows(docs).count() == sum(r["times"] for r in out)
    assert [tuple(r) for r in mix(docs).orderBy("doc_id").collect()] == sorted(map(tuple, out))


def test_repeats_equal_brute_force(spark, sf, texts):
    first = {}
    for k in sorted(texts):
        b = (texts[k] or "").encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i : i + 50], k)
    got = {r["doc_id"]: r for r in queries()["op7_suffix_array_dedup"](spark, sf).collect()}
    for k, t in texts.items():
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < k:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = len(re.findall(b"\1+", bytes(gone)))
        r = got[k]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(b), sum(gone), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 500, 4096):
        bucket, a, b = rng.integers(0, n // 3 + 1, n), rng.integers(0, 1 << 32, n), rng.integers(0, 1 << 32, n)
        p, q = displaced(bucket, a, b)
        assert sorted(((a + p * b) % 4294967291 + q) % n) == list(range(n))


def test_exact_dedup_groups_members_and_others(spark):
    docs = spark.createDataFrame([(1, "Ab"), (2, "aB"), (3, "é"), (4, "É"), (5, None), (6, ""), (7, "ab")], "doc_id long, text string")
    for history in (docs, docs.limit(0), docs.where("doc_id < 3")):
        got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(docs, history).collect()}
        assert got == {
            1: (7, 3, False), 2: (7, 3, False), 7: (7, 3, True), 3: (3, 1, True), 4: (4, 1, True), 5: (6, 2, False), 6: (6, 2, True),
        }


def test_wrappers(spark):
    page = (
        "<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><div class='cookie notice'>Accept</div>"
        "<article><h1>Head &amp; line</h1><p>First <b>bold</b>\n text<p>Second<ul><li>x<li>y</ul>"
        "<div class=comments><p>nice</p></div></article><aside>More</aside><script>var t='</p>';</script><footer>&copy;</footer></body></html>"
    )
    rows = [(1, "http://h.example/1", page), (2, "http://h.example/2", page.replace("<p>Second", "")), (3, None, None), (4, "http://i.example", "plain <b>text")]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "Head & line\nFirst bold text\nSecond\nx\ny", 2: "Head & line\nFirst bold text\nx\ny", 3: "", 4: "plain text"}
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_every_article_of_the_pages_table(spark, sf):
    import html as entities

    got = {r["page_id"]: r["text"] for r in queries()["op9_html_extraction"](spark, sf).collect()}
    for i, page in duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall():
        inside = re.search("<article>(.*)</article>", page, re.S)[1]
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>|<br>", inside)]
        assert got[i] == "\n".join(filter(None, parts))


def test_ids_and_packing(spark, sf, texts):
    encoder = packing.Encoder()
    import pyarrow as pa

    from tidepanel.llm.common import flat

    some = [*filter(None, texts.values()), "it's we'll ''s \n's  two　x ", "", "\n\n a", "１２½ d'"]
    ids, first = encoder.encode(*flat(pa.array(some)))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [encoder.bpe.encode_ordinary(t) for t in some]
    rows = queries()["op10_best_fit_packing"](spark, sf).collect()
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.SIZE
    total = sum(r["length"] for r in rows)
    assert total == sum(len(encoder.bpe.encode_ordinary(t or "")) + 1 for t in texts.values())
    assert len(bins) <= 1.05 * total / packing.SIZE + 1


def test_pipeline(spark, sf, tmp_path):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start = docs
    for k, (_, stage) in enumerate(c.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(c.STAGES) - 1:
            assert docs.columns == start.columns and docs.count() > 0
    assert docs.where("length > 2048").count() == 0
