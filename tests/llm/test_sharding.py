import zlib
from collections import Counter

from divtide.llm.sharding import external_shuffle, stored_shards, write_shards
from tests.llm.conftest import EDGES


def placed(rows, n):
    shards = Counter(r["shard"] for r in rows)
    for shard, count in shards.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(count))
    counts = [shards.get(s, 0) for s in range(n)]
    assert max(counts) - min(counts) <= 1
    return counts


def test_law_and_digests(frame):
    rows = external_shuffle(frame(EDGES), 4).collect()
    placed(rows, 4)
    expected = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in EDGES)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected


def test_hot_and_empty(frame):
    assert external_shuffle(frame([]), 4).count() == 0
    rows = external_shuffle(frame([(7, "same")] * 500 + [(i, "x") for i in range(100)], 5), 7).collect()
    placed(rows, 7)
    # Copies of one row are spread like any others.
    assert max(Counter(r["shard"] for r in rows if r["doc_id"] == 7).values()) < 90


def test_same_seed_same_order_and_shuffled(frame):
    docs = frame([(i, str(i)) for i in range(400)], 1)
    one, two = ({r["doc_id"]: (r["slot"], r["shard"]) for r in external_shuffle(docs, 5).collect()} for _ in range(2))
    assert one == two
    other = {r["doc_id"]: (r["slot"], r["shard"]) for r in external_shuffle(docs, 5, seed=18).collect()}
    assert sum(one[i] == other[i] for i in one) < 40
    in_order = [i for i, _ in sorted(one.items(), key=lambda x: x[1])]
    assert sum(a < b for a, b in zip(in_order, in_order[1:])) in range(150, 250)


def test_writes_whole_records(spark, frame, tmp_path):
    docs = frame([(i, f"text {i}") for i in range(50)])
    placed_rows = external_shuffle(docs, 3, payload=tuple(docs.columns))
    write_shards(placed_rows, str(tmp_path / "out"), rows_per_file=10)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["text"] for r in back.collect()) == sorted(f"text {i}" for i in range(50))
    assert {r["_shard"] for r in back.collect()} == {0, 1, 2}


def test_whole_records_travel_unasked(frame):
    """All columns arrive, and the digests of the written shards are those of the texts in them."""
    docs = frame(EDGES)
    shuffled = external_shuffle(docs, 4)
    columns = sorted(docs.columns)
    arrived = Counter(tuple(r["record"][c] for c in columns) for r in shuffled.collect())
    assert arrived == Counter(tuple(r[c] for c in columns) for r in docs.collect())
    rows = stored_shards(shuffled).collect()
    placed(rows, 4)
    expected = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in EDGES)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    assert stored_shards(external_shuffle(frame([]), 4)).count() == 0
