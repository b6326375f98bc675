"""Steps of the removal of repeats: windows are named in small chunks, removed spans are united per row."""

import pyarrow as pa

from tidepanel.llm import repeats


def test_windows_are_named_in_small_chunks(monkeypatch):
    texts = [f"{i} " + "some words that are repeated in a text of no great length " * 20 for i in range(1500)]  # 1.8 MB
    sizes, names = [], repeats.names
    monkeypatch.setattr(repeats, "names", lambda data, offsets: sizes.append(len(data)) or names(data, offsets))
    ids = list(range(len(texts)))
    batch = pa.RecordBatch.from_pydict({"doc_id": ids, "p": ids, "text": texts})
    assert sum(b.num_rows for b in repeats._named([batch], 4)) > 0
    assert sum(sizes) == sum(map(len, texts))
    assert len(sizes) > 10 and max(sizes) <= repeats.CHUNK


def test_cut_takes_united_spans_of_each_row():
    texts, spans = ["abcdefghij", None, "", "0123456789", "éa"], [[(2, 4), (4, 6), (8, 10)], None, [], [(0, 3), (1, 5)], [(0, 2)]]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))
    rows = [None if s is None else [{"first": a, "behind": b} for a, b in s] for s in spans]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts), pa.array(rows, kind)], names=["doc_id", "text", "spans"])
    got = [r for part in (batch, batch.slice(3, 2)) for b in repeats._cut([part]) for r in b.to_pylist()]
    want = [(10, 6, 2, b"abgh"), (0, 0, 0, b""), (0, 0, 0, b""), (10, 5, 1, b"56789"), (3, 2, 1, b"a")]
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept"]) for r in got] == want + want[3:]
