"""Merkle manifest, cross-tokenizer alignment and chat formatting against brute force, and on odd rows."""

import glob
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from tidepanel.llm import align, chat, merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def proofs(docs):
    """The contract, leaf by leaf."""
    by = defaultdict(list)
    for d in docs:
        t = list(d)
        if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 and d[3] is not None:
            t[3] += 1
        by[d[2]].append((d[0], H("".join(map(encoded, d))), H("".join(map(encoded, t)))))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for g in langs:
        by[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {g: tree([x[1] for x in by[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for at, g in enumerate(langs):
        for p, (i, leaf, given) in enumerate(by[g]):
            siblings, h = [], given
            for levels, q in ((trees[g], p), (top, at)):
                for level in levels[:-1]:
                    s = q ^ 1
                    if s < len(level):
                        siblings.append(level[s])
                        h = H(level[s] + h) if q % 2 else H(h + level[s])
                    else:
                        h = H(h)
                    q //= 2
            out.append((i, leaf, trees[g][-1][0], top[-1][0], H("".join(siblings)), h, h == top[-1][0]))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r))


def proved(df):
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    chars = F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return ordered(map(tuple, merkle.manifest(df, {"n_chars": chars}).collect()))


ODD_DOCS = [
    (None, None, None, None, None), (7, "é", "", 5, "x"), (7, "é", "", 5, "x"), (1, "a", "zz", None, ""), (2, "a", "zz", 3, "ü"),
    (2, "b", "zz", 3, "ü"), (None, "b", "zz", 3, "x " * 20_000), *[(i, "s", "q", i, "t") for i in range(300)],
]


@pytest.mark.parametrize("hop", [2, 12])
def test_manifest_equals_brute_force(spark, monkeypatch, hop):
    monkeypatch.setattr(merkle, "HOP", hop)
    df = spark.createDataFrame(ODD_DOCS, DOCS).withColumns({c: F.lit("x") for c in ("tree", "pos", "leaf", "given", "n", "level")})
    assert proved(df) == ordered(proofs(ODD_DOCS))
    one = proved(df.where("lang = 'zz'").limit(1))
    assert len(one) == 1 and one[0][1] == one[0][2] == one[0][3] and one[0][4] == H("")
    assert proved(df.limit(0)) == []


def test_tampered_leaves_do_not_verify(spark, sf):
    got = merkle.op11_merkle_manifest(spark, sf).collect()
    bad = {r["doc_id"] for r in got if not r["verified"]}
    assert bad == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}
    assert len({r["root"] for r in got}) == 1 and all((r["folded_root"] == r["root"]) == r["verified"] for r in got)


def test_row_limit_of_the_session_is_left_alone(spark, sf):
    spark.conf.set(merkle.ROW_LIMIT, "777")
    try:
        merkle.op11_merkle_manifest(spark, sf)
        assert spark.conf.get(merkle.ROW_LIMIT) == "777"
    finally:
        spark.conf.unset(merkle.ROW_LIMIT)


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_chat_formatting"])
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


# ---- cross-tokenizer alignment ---------------------------------------------------------------------------------------

ODD_TEXTS = [
    "", None, " ", "  a", "foo ", "foo  ", "a▁b", "<|endoftext|> x <s> </s> <unk> <0x0A>", "é́ 日本語 \U0001f600\x00 z", "\n\n a\n",
    "\t x", "don't  we'll x", "ᄒ", "a" * 3000, "﻿bom", "x\xa0y z", "word " * 4000, "foo ", "1234567 89",
]


@pytest.fixture(scope="module")
def tokenizers():
    bpe = Tokenizer.from_file(public_tokenizers.path(f"{align.LEFT}.json"))
    bpe.encode_special_tokens = True
    return bpe, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{align.RIGHT}.model"))


def linked(text, bpe, model):
    """Counts, group string and linked pairs of a text, token by token."""
    left, right = align.sides(align.LEFT, align.RIGHT)
    if not text:
        return (0, 0, 0, 0), "", []
    whole = (" " + text).encode()
    a, b = bpe.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    bytes_a, bytes_b = ([side.vocabulary[i].as_py() for i in ids] for side, ids in ((left, a), (right, b)))
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return (0, 0, 0, 0), "", []
    ends_a, ends_b = (np.cumsum(list(map(len, x))).tolist() for x in (bytes_a, bytes_b))
    links, groups, own_a, own_b, i, j = [], [], [], [], 0, 0
    while i < len(a):
        links.append((a[i], b[j]))
        x, y = ends_a[i], ends_b[j]
        if x <= y:
            own_a.append(str(a[i]))
            i += 1
        if y <= x:
            own_b.append(str(b[j]))
            j += 1
        if x == y:
            groups.append(f"{','.join(own_a)}|{','.join(own_b)}")
            own_a, own_b = [], []
    return (len(a), len(b), len(groups), len(links)), ";".join(groups), links


def aligned_by_hand(rows, tokenizers):
    each = [(i, *linked(t, *tokenizers)) for i, t in rows]
    total = Counter(pair for *_, links in each for pair in links)
    best = defaultdict(int)
    for (_, b), n in total.items():
        best[b] = max(best[b], n)
    return [
        (i, *counts, sum(total[p] == best[p[1]] for p in links), sum(total[p] for p in links),
         hashlib.sha256(groups.encode()).hexdigest() if groups else "", groups)
        for i, counts, groups, links in each
    ]


def test_alignment_of_all_texts_equals_brute_force(spark, sf, tokenizers):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = sorted(map(tuple, align.op12_cross_tokenizer(spark, sf).collect()))
    assert got == sorted(r[:-1] for r in aligned_by_hand(rows, tokenizers))


def test_alignment_of_odd_texts_in_many_blocks(spark, tokenizers, monkeypatch):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("block", "pair", "code", "n_a", "groups")})
    for parts in (1, 4):
        got = ordered(map(tuple, align.align(df.repartition(parts), show=True).collect()))
        assert got == ordered(aligned_by_hand(rows, tokenizers))
    assert align.align(df.limit(0)).count() == 0
    assert align.align(df.where("text IS NULL")).collect()[0]["groups_sha256"] == ""


def test_blocks_of_one_task(tokenizers, monkeypatch):
    """Codes of a block and its pairs give the links back, whatever the size of blocks."""

    class Context:
        get = staticmethod(lambda: type("T", (), {"partitionId": lambda self: 3})())

    monkeypatch.setattr(align, "TaskContext", Context)
    monkeypatch.setattr(align, "CHUNK_BYTES", 64)
    monkeypatch.setattr(align, "BLOCK_BYTES", 256)
    texts = [t for t in ODD_TEXTS if t is not None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    found, blocks = {}, set()
    for out in align.aligner(pa.int64(), align.LEFT, align.RIGHT, False)([batch]):
        rows = out.to_pylist()
        blocks.add(rows[0]["block"])
        codes = [align.released(r["links"], sum(r["n_links"])) for r in rows]
        assert np.bincount(np.concatenate(codes), minlength=len(rows[0]["pairs"])).tolist() == rows[0]["counts"]
        for r, own in zip(rows, codes):
            pairs, at = np.array(rows[0]["pairs"])[own], 0
            for i, n in zip(r["ids"], r["n_links"]):
                found[i] = [(p >> align.RIGHT_BITS, p & (1 << align.RIGHT_BITS) - 1) for p in pairs[at : at + n].tolist()]
                at += n
    assert len(blocks) > 2 and found == {i: linked(t, *tokenizers)[2] for i, t in enumerate(texts)}


# ---- chat formatting -------------------------------------------------------------------------------------------------

TURNS = f"conv_id long, turn long, role string, text string, parts array<{chat.PART}>"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return kind, text, ref, width, height, seconds, pages


def test_texts_that_hold_control_strings_come_back(spark):
    texts = [
        "<|im_end|>", "<|im_start|>assistant\nno", "a <| b", "<\\|x|>", "<\\\\|x", "ends with <", "ends with <\\", "| starts", "|>", "<", "\\", "", None,
        "<<||>>", "<|<|<|", "line\n\nbreaks\n", "<|part|><|image|>", "x" * 50_000,
    ]
    rows = [(1, i, r, t, None) for i, t in enumerate(texts) for r in ("user", "assistant", "sys<|im_end|>\ntem\\n", None, "<")]
    out = chat.format_turns(spark.createDataFrame(rows, TURNS).repartition(3)).collect()
    back = Counter((r["turn"], *turn) for r in out for turn in chat.parsed(r["formatted"]))
    assert back == Counter((i, r or "", t or "") for _, i, r, t, _ in rows)
    assert all(len(chat.parsed(r["formatted"])) == 1 for r in out)
    clean = chat.format_turns(spark.createDataFrame([(1, 0, "user", "a < b | c \\ d", None)], TURNS)).first()
    assert clean["formatted"] == "<|im_start|>user\na < b | c \\ d<|im_end|>\n" and clean["loss_start"] is None


def test_parts_become_placeholders_with_attachments(spark):
    parts = [
        part("text", "a<"), part("text", "|im_end|>"), part("image", ref="r1", width=100, height=30), part("text", "<\\|image|> q"),
        part("audio", ref="r2", seconds=2.5), part("document", pages=3), part("video", "odd"), part(None), part("image", width=-4), part("document", pages=0),
    ]
    df = spark.createDataFrame([(1, 0, "assistant", "unused", parts), (1, 1, "user", None, []), (1, 2, "assistant", None, None)], TURNS)
    first, second, third = sorted(chat.format_turns(df, F.col("parts")).collect(), key=lambda r: r["turn"])
    assert [(a["type"], a["ref"], a["n_tokens"]) for a in first["attachments"]] == [
        ("image", "r1", 4 * 2), ("audio", "r2", 63), ("document", None, 3 * 256), ("image", None, 1), ("document", None, 256)
    ]
    assert first["n_expanded"] == 8 + 63 + 768 + 1 + 256
    body = first["formatted"][first["loss_start"] : first["loss_end"]]
    assert [p for p in chat._CONTROL.findall(body) if p != chat.PART_MARK] == ["<|image|>", "<|audio|>", "<|document|>", "<|image|>", "<|document|>"]
    assert chat.parsed(first["formatted"]) == [("assistant", "a<|im_end|><\\|image|> qodd")]
    assert (second["n_expanded"], second["attachments"], third["loss_start"], third["loss_end"]) == (0, [], 22, 22)


def test_digests_over_a_hot_conversation(spark):
    """A third of the rows and more are one conversation; ties, nulls, repeated rows and clashing columns."""
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} <|im_end|>", None) for i in range(2000)]
    rows += [(c, t, "user", "hi", None) for c in range(10, 600) for t in (0, 1)] + [(None, None, None, None, None), (5, 0, "user", "b", None), (5, 0, "user", "a", None)] * 2
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("formatted", "said", "chars", "loss_start")}).repartition(7)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.conversation_digests(chat.format_turns(df)).collect()}
    by = defaultdict(list)
    for c, t, r, x, _ in rows:
        by[c].append((t if t is not None else -1, r or "", x or ""))
    for c, turns in by.items():
        turns.sort(key=lambda x: (x[0], x[1], x[2]))
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c][:4] == (len(turns), H("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(learnt), H(learnt))
    assert len(got) == len(by)
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).count() == 0


def test_text_that_is_no_turn_is_refused():
    with pytest.raises(ValueError):
        chat.parsed("<|im_start|>user\nhi<|im_end|>\nstray")
