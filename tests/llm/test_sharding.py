import zlib

import numpy as np

from kotonoha.llm import sharding
from tests.llm.helpers import ODD_TEXT, empty_documents, odd_documents


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_loop():
    keys = np.random.default_rng(1).integers(0, 1 << 64, 500, np.uint64, endpoint=False)
    keys[:3] = [0, 1, (1 << 64) - 1]
    for shards in (1, 2, 40, 41):
        assert sharding.jump_hash(keys, shards).tolist() == [plain_jump(int(k), shards) for k in keys]


def test_one_more_shard_takes_rows_only_into_itself(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "cast(id % 7 AS string) AS text")
    rows = sharding.assign_shards(docs).collect()
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert all(r["grown_shard"] == 40 for r in moved)
    assert 40 < len(moved) < 180
    slots = {}
    for r in rows:
        assert r["size"] == 17 and r["text_crc32"] == zlib.crc32(str(r["doc_id"] % 7).encode()) and r["law"] == "key"
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(slots) == 40
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.assign_shards(docs.repartition(9)).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = sharding.assign_shards(docs).collect()
    assert len(rows) == docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[2][0]["size"] == by_id[3][0]["size"] == 16 and by_id[2][0]["text_crc32"] == 0
    assert len({r["shard"] for r in by_id[5]}) == 1 and len({r["slot"] for r in by_id[5]}) == 2
    assert by_id[8][0]["size"] == 16 + len(ODD_TEXT.encode())
    assert sharding.assign_shards(empty_documents(spark)).count() == 0


def test_one_hot_shard(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, NULL, id) AS doc_id", "'t' AS text")
    rows = sharding.assign_shards(docs, shards=5).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
