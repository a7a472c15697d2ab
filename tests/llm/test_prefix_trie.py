"""The prefix trie against SQL, on awkward conversations and with queues that spill."""

from __future__ import annotations

import random

import pytest
from vitrine.llm import prefix_trie

from .test_operators import oracle, sorted_rows


def awkward_turns() -> list[tuple]:
    rnd, rows = random.Random(5), []
    for conv in [*range(0, 90), *range(200, 230), 1003, 1019, 1021]:  # 1000 and 1020 are absent
        for turn in range(rnd.choice([1, 1, 2, 3, 5])):
            rows.append((conv, turn, rnd.choice(["user", "user", None]), rnd.choice(["hello there", "hello there", " two  words\n", "", None, "é x"])))
    rows += [(7, None, "system", "first"), (7, 0, "user", "a tie"), (7, 0, "user", "a tie"), (7, 0, "assistant", "a tie")]
    rows += [(300, t, "user", "deep " * (t % 4)) for t in range(120)] + [(301, t, "user", "deep " * (t % 4)) for t in range(120)]
    rows += [(400 + k, t, "user", "common") for k in range(40) for t in range(4)]
    rows += [(500, 0, "user", "long " * 50_000), (501, None, None, None)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, length int, at string, shard string"


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*r, "clash", "clash", 1, "clash", "clash") for r in awkward_turns()], SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("shard_rows, queue", [(1_000, 100_000), (30, 2), (0, 1)])
def test_trie_equals_sql(turns, shard_rows, queue):
    found = prefix_trie.trie(turns, shard_rows=shard_rows, queue=queue)
    want = oracle(prefix_trie.oracle(), conversations=turns.select("conv_id", "turn", "role", "text").toArrow())
    assert sorted_rows(found.collect()) == want
    assert all(f.dataType.simpleString() == "bigint" for f in found.schema if f.name != "ends_sha256")


def test_empty_and_nameless_conversations(spark, turns):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    nameless = spark.createDataFrame([(None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(nameless).count() == 0
    # Only turnless conversations: a root without children.
    gone = [c for c in range(2000, 2040) if c % 20 and prefix_trie_crc(c) % 4]
    rows = spark.createDataFrame([(c, 0, "user", "x") for c in gone], "conv_id long, turn long, role string, text string")
    (root,) = prefix_trie.trie(rows).collect()
    assert (root["conv_id"], root["depth"], root["parent_conv_id"], root["n_convs"], root["n_children"], root["n_leaves"]) == (min(gone), 0, None, len(gone), 0, 1)


def prefix_trie_crc(conv: int) -> int:
    import zlib

    return zlib.crc32(str(conv).encode())


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_queue_gives_messages_in_order_however_small(most):
    rnd, queue, waiting = random.Random(1), prefix_trie.SpillingQueue(most, most_runs=3), {}
    for depth in range(30, 0, -1):
        for key in sorted(k for k in waiting if k[0] == -depth):
            assert sorted(queue.take(key)) == sorted(waiting.pop(key))
        assert queue.take((-depth, b"zz")) == []
        for _ in range(rnd.randint(0, 40)):
            key, value = (1 - depth, bytes([rnd.randint(97, 104)])), (rnd.randint(0, 5), rnd.randint(0, 5))
            queue.push(key, value)
            waiting.setdefault(key, []).append(value)
    assert most > 900 or queue.spilled > 10


def test_ids_are_joined_in_pieces(spark):
    import hashlib

    rows = [(b"hot", i) for i in range(-50, 9000, 3)] + [(b"a", 5)]
    found = prefix_trie.id_digests(spark.createDataFrame(rows, "node binary, conv_id long").repartition(4), piece=100)
    want = hashlib.sha256(",".join(str(i) for i in range(-50, 9000, 3)).encode()).hexdigest()
    assert {bytes(r["node"]): r["ends_sha256"] for r in found.collect()} == {b"hot": want, b"a": hashlib.sha256(b"5").hexdigest()}
