import random

import numpy as np

from starloom.llm.packing import RoomTree, best_fit_decreasing, pack_rows, unpack_rows


def test_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(200):
        length = rng.randrange(1, 40)
        sizes = np.array([rng.randrange(1, length + 1) for _ in range(rng.randrange(60))], dtype=np.int64)
        rooms = []
        for size in sorted(sizes.tolist(), reverse=True):
            fitting = [r for r in rooms if r >= size]
            room = min(fitting) if fitting else length
            if fitting:
                rooms.remove(room)
            rooms.append(room - size)
        rows = best_fit_decreasing(sizes, length)
        assert sorted(length - int(sizes[row].sum()) for row in rows) == sorted(rooms)
        assert sorted(i for row in rows for i in row) == list(range(len(sizes)))


def test_room_tree_is_empty_after_all_is_taken():
    tree = RoomTree(8)
    tree.put(5, 1)
    tree.put(5, 2)
    assert tree.take(6) is None and tree.take(1) == (5, 2) and tree.take(5) == (5, 1) and tree.take(0) is None
    assert not any(tree.any)


def test_round_trip(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randrange(50_000) for _ in range(rng.choice([0, 1, 5, 30, 64, 65, 300]))]) for i in range(200)]
    rows += [(None, [1, 2, 3]), (900, None), (7, [9]), (7, [9])]
    frame = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, ids array<int>, row string")
    packed = pack_rows(frame.repartition(3), length=64, pad=-1 & 0xFFFF, batch_tokens=1000)
    total = 0
    for row in packed.collect():
        ids, places = np.frombuffer(row["ids"], "<u4"), np.frombuffer(row["positions"], "<u4")
        assert len(ids) == len(places) == 64 and row["cu_seqlens"][0] == 0 and row["cu_seqlens"][-1] == row["n_tokens"]
        for a, b in zip(row["cu_seqlens"], row["cu_seqlens"][1:]):
            assert places[a:b].tolist() == list(range(b - a))
        assert (ids[row["n_tokens"]:] == 0xFFFF).all() and (places[row["n_tokens"]:] == 0).all()
        total += row["n_tokens"]
    assert packed.select("shard", "row").distinct().count() == packed.count()
    assert total == sum(len(ids or []) for _, ids in rows)
    got = {}
    for r in unpack_rows(packed).collect():
        got.setdefault(r["doc_id"], []).append((r["piece"], r["ids"]))
    for doc, ids in rows:
        if doc == 7:
            continue
        assert [t for _, piece in sorted(got.get(doc, [])) for t in piece] == (ids or [])
    cut = [ids[i: i + 64] for doc, ids in rows if doc == 7 for i in range(0, len(ids), 64)]
    assert sorted(ids for _, ids in got[7]) == sorted(cut)
    assert pack_rows(frame.limit(0)).count() == 0
