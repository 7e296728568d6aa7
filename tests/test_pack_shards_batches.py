"""Packing, re-sharding and batching against closed forms and written-out
results."""

import random
from itertools import accumulate, chain

from quire.operators.batches import batch_and_pad, budget_batches
from quire.operators.pack import pack_sequences
from quire.operators.shards import reshard_by_tokens


def test_packing_cuts_the_flattened_ids(spark):
    rnd = random.Random(11)
    for size in (1, 4, 16, 64):
        docs = [[rnd.randint(0, 999) for _ in range(rnd.choice([0, 1, 2, 3, 10, 40, 100]))] for _ in range(60)]
        rows = [("train" if i < 45 else "test", i, d) for i, d in enumerate(docs)]
        df = spark.createDataFrame(rows, "split string, doc_id long, input_ids array<int>")
        got = {(r.split, r.seq_id): list(r.input_ids) for r in pack_sequences(df, size, order="doc_id", group=["split"]).collect()}
        want = {}
        for split, part in (("train", docs[:45]), ("test", docs[45:])):
            flat = list(chain.from_iterable(part))
            want |= {(split, k): flat[k * size:(k + 1) * size] for k in range(len(flat) // size)}
        assert got == want


def test_packing_written_out(spark):
    df = spark.createDataFrame([("t", 3, [1, 2]), ("t", 5, []), ("t", 9, [3, 4, 5, 6, 7])],
                               "split string, doc_id long, input_ids array<int>")
    got = sorted((r.seq_id, list(r.input_ids)) for r in pack_sequences(df, 3, order="doc_id", group=["split"]).collect())
    assert got == [(0, [1, 2, 3]), (1, [4, 5, 6])]


def shard_starts(before, total, n):
    """Each shard begins at the first sequence that has at least total / n
    tokens between the shard before it and itself."""
    starts = [0]
    while len(starts) < n:
        later = [b for b in before if (b - starts[-1]) * n >= total]
        if not later:
            break
        starts.append(later[0])
    return starts


def test_reshard_by_prefix_sums(spark):
    rnd = random.Random(2)
    cases = [
        [5] * 7,                                   # equal lengths
        [rnd.randint(1, 30) for _ in range(50)],   # unequal
        [3, 100, 2, 2, 2, 1],                      # one longer than the target
        [4, 4],                                    # fewer sequences than shards
    ]
    for lengths in cases:
        before = [0, *accumulate(lengths)][:-1]
        for n in (1, 3, 4, 8):
            df = spark.createDataFrame(list(enumerate(lengths)), "seq_id long, n_tokens long")
            got = {r.seq_id: r.shard for r in reshard_by_tokens(df, n).collect()}
            starts = shard_starts(before, sum(lengths), n)
            assert [got[i] for i in range(len(lengths))] == [sum(s <= b for s in starts) - 1 for b in before], (lengths, n)


def test_shard_starts_in_one_job_and_in_many(spark):
    """Few long among many short sequences; windows that overlap, windows that
    hold more rows than allowed, and the number of jobs."""
    from quire.operators.shards import _starts
    rnd = random.Random(5)
    lengths = [rnd.choice([1, 1, 1, 2, 40]) for _ in range(400)] + [1] * 300 + [90, 2, 2]
    before = [0, *accumulate(lengths)][:-1]
    x = spark.createDataFrame([(b,) for b in before], "_cb long")
    for n in (1, 2, 7, 60, 500):
        want = shard_starts(before, sum(lengths), n)
        for most in (1, 3, 50, 100_000):
            if n * 3 <= most or n <= 7:
                assert _starts(x, n, sum(lengths), max(lengths), len(lengths), most) == want, (n, most)
    sc = spark.sparkContext
    sc.setJobGroup("starts", "shard starts")
    _starts(x, 60, sum(lengths), max(lengths), len(lengths))
    jobs = sc.statusTracker().getJobIdsForGroup("starts")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2                                      # with adaptive execution, a job per stage


def test_reshard_written_out(spark):
    df = spark.createDataFrame(list(enumerate([3, 100, 2, 2, 2, 1])), "seq_id long, n_tokens long")
    assert [r.shard for r in reshard_by_tokens(df, 3).orderBy("seq_id").collect()] == [0, 0, 1, 1, 1, 1]


def test_batch_and_pad(spark):
    seqs = [[1, 2, 3], [], [4], [5, 6, 7, 8, 9], [10, 11]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "seq_id long, input_ids array<int>")
    got = sorted(batch_and_pad(df, 2).collect(), key=lambda r: r.seq_id)
    exp = [[1, 2, 3], [0, 0, 0], [4, 0, 0, 0, 0], [5, 6, 7, 8, 9], [10, 11]]
    assert [list(r.input_ids) for r in got] == exp
    assert all(list(r.labels) == list(r.input_ids) for r in got)
    assert [r.batch_id for r in got] == [0, 0, 1, 1, 2]


def test_token_budget(spark):
    # lengths, rows per batch, budget -> ids counted after each step
    cases = [
        ([3, 5, 2], 2, 7, [10]),                             # below one batch
        ([4] * 5, 4, 16, [16]),                              # exactly one batch
        ([2, 2], 5, 11, [10, 20]),                           # a batch spans several epochs
        ([1, 9, 3, 3], 3, 200, [27, 54, 63, 90, 117, 144, 153, 180, 207]),
    ]
    for lengths, rows, budget, want in cases:
        df = spark.createDataFrame(list(enumerate(lengths)), "seq_id long, n_tokens long")
        got = sorted(budget_batches(df, rows, budget).collect(), key=lambda r: r.step)
        assert [r.cum_tokens for r in got] == want, (lengths, rows, budget)


def test_budget_of_many_epochs(spark):
    """Step by step against a plain loop, and the source's 300 billion tokens
    without repeating the rows."""
    lengths, rows, budget = [3, 1, 4, 1, 5, 9, 2], 4, 3000
    df = spark.createDataFrame(list(enumerate(lengths)), "seq_id long, n_tokens long")
    want, at, total = [], 0, 0
    while total < budget:
        batch = [lengths[(at + i) % 7] for i in range(rows)]
        total += rows * max(batch)
        want.append((len(want) + 1, at // 7, rows, max(batch), rows * max(batch), total))
        at += rows
    assert sorted(tuple(r) for r in budget_batches(df, rows, budget).collect()) == want
    long = budget_batches(df, rows, 300_000_000_000)
    per = sum(w[4] for w in want[:7])
    assert long.where("step = 7000000").first().cum_tokens == per * 1_000_000
    assert long._jdf.queryExecution().optimizedPlan().toString().count("Range") == 1


def test_labels_of_the_input_are_padded(spark):
    df = spark.createDataFrame([(0, [1, 2], [7, 8]), (1, [3], [9])], "seq_id long, input_ids array<int>, labels array<int>")
    got = batch_and_pad(df, 2).orderBy("seq_id").collect()
    assert [list(r.labels) for r in got] == [[7, 8], [9, 0]] and [list(r.input_ids) for r in got] == [[1, 2], [3, 0]]
