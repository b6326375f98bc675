"""Every stage of the pipeline against what it has to do, worked out from its own input; and the pipeline on odd rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidepanel.llm import mixing, neardup, packing, quality
from tidepanel.session import materialise

import public_tokenizers


@pytest.fixture(scope="module")
def stages(spark, sf):
    """(input, output) of every stage over all documents."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = materialise(stage(spark, docs, sf))
        out[name] = docs, done
        docs = done
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_quality_keeps_whole_rows_that_pass(spark, sf, stages):
    before, after = stages["quality_rules"]
    kept = {r["doc_id"] for r in rows(quality.op2_quality_rules(spark, sf)) if r["kept"]}
    key = lambda r: (r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"])
    assert Counter(map(key, rows(after))) == Counter(key(r) for r in rows(before) if r["doc_id"] in kept)


def test_removed_lines_stand_in_an_earlier_document(stages):
    before, after = stages["line_dedup"]
    texts = {r["doc_id"]: r["text"] for r in rows(before)}
    seen = defaultdict(set)
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            seen[line.strip()].add(i)
    left = {r["doc_id"]: r for r in rows(after)}
    gone = 0
    for i, text in texts.items():
        mine = left[i]["text"].split("\n") if i in left else []
        at = 0
        for line in text.split("\n"):  # what is left is a part of the text, in order
            if at < len(mine) and mine[at] == line:
                at += 1
            elif line.strip():
                assert min(seen[line.strip()]) < i
                gone += 1
        assert at == len(mine)
        assert i not in left or left[i]["n_chars"] == len(left[i]["text"])
    assert gone > 0 and set(left) <= set(texts)


def test_one_document_of_each_class_stays(stages):
    before, after = stages["near_dedup"]
    of = {r["doc_id"]: r["class_id"] for r in neardup.classes(before).collect()}
    stay = [r["doc_id"] for r in rows(after)]
    assert sorted(stay) == sorted(set(of.values())) and len(stay) <= len(of)
    text = {r["doc_id"]: r["text"] for r in rows(before)}
    assert all(r["text"] == text[r["doc_id"]] for r in rows(after))


def test_mix_takes_what_its_targets_say(stages):
    before, after = stages["mix_sources"]
    size = lambda t: len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w])
    given, taken, most = Counter(), Counter(), Counter()
    for r in rows(before):
        given[r["source"]] += size(r["text"])
        most[r["source"]] = max(most[r["source"]], size(r["text"]))
    times = Counter()
    for r in rows(after):
        taken[r["source"]] += size(r["text"])
        times[r["doc_id"]] += 1
    assert max(times.values()) <= mixing.MOST
    order = sorted(given, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % len(mixing.WEIGHTS)] for k, s in enumerate(order)}
    open_, target, rest = set(order), {}, float(sum(given.values()))
    while True:  # shares by weight, at most so many times a source's size
        share = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if share * weight[s] > mixing.MOST * given[s]}
        if not above:
            break
        for s in above:
            target[s] = mixing.MOST * given[s]
            rest -= target[s]
        open_ -= above
    target |= {s: share * weight[s] for s in open_}
    for s in order:
        assert abs(taken[s] - target[s]) <= most[s] / 2 + 1


def test_packing_holds_every_token_once(stages):
    before, after = stages["best_fit_packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{packing.TOKENIZER}.json"))
    want = Counter()
    for r in rows(before):
        want[r["doc_id"]] += len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    got, bins = Counter(), defaultdict(list)
    for r in rows(after):
        got[r["doc_id"]] += r["length"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.SIZE


def test_odd_rows_go_through_all_stages(spark, sf):
    base = " ".join(f"alpha{i} the beta{i} and gamma{i} of" for i in range(20)) + "."
    data = [
        (1, base, "en", "web", 5, "x"), (1, base, "en", "web", 5, "x"), (None, base + " tail", None, None, None, "x"), (2, None, "en", "web", None, "x"),
        (3, "", "en", "web", 0, "x"), (4, " \n\t ", "en", None, 4, "x"), (5, " ".join(f"delta{i} the eta{i} and" for i in range(20_000)) + ".", "en", "web", 1, "x"),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, _key string")
    for table in (docs, docs.limit(0)):
        done = table
        for name, stage in corpus_pipeline.STAGES:
            columns = done.columns
            done = materialise(stage(spark, done, sf))
            assert done.columns == columns or name == corpus_pipeline.STAGES[-1][0]
        assert (done.count() > 0) == (table is docs)
