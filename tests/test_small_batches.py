import pyarrow as pa

from tidewater.operators import scoring
from tidewater.sources import pages


class Kept:
    """A frame that keeps the function it is mapped by."""
    columns = ["t"]

    def __init__(self, schema):
        self.schema = schema

    def mapInArrow(self, fn, _):
        self.fn = fn


def test_encoded_rows_go_on_call_by_call(spark):
    frame = Kept(spark.createDataFrame([("a",)], "t string").schema)
    scoring.encode(frame, "t", batch_size=8)
    texts = [None, "", *(f"text number {i}" for i in range(98))]
    out = list(frame.fn([pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])]))
    assert max(b.num_rows for b in out) == 8
    want = scoring.hashed_trigram_encoder()([t or "" for t in texts])
    assert pa.Table.from_batches(out).to_pydict() == {"t": texts, "embedding": want.tolist()}


def test_parsed_pages_go_on_in_small_batches():
    n = 200
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([f"https://x.org/{i}" for i in range(n)]), pa.array([None, *("<p>a</p>" for _ in range(n - 1))])], ["page_id", "url", "html"])
    out = list(pages._parse_batches([batch]))
    assert max(b.num_rows for b in out) <= 64 and sum(b.num_rows for b in out) == n
    assert pa.Table.from_batches(out).column("nodes").to_pylist() == [[], *([["a"]] * (n - 1))]
