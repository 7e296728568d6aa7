"""Exact and near dedupe against brute force; language ID; BPE."""

import collections
import itertools

from pyspark.sql import functions as F

from quire.operators.dedupe import components, exact_dedupe, minhash_edges, near_dup_survivors, similar_pairs


def test_exact_dedupe_first_wins(spark):
    rows = [(4, " a b "), (2, "c"), (7, "a b"), (1, ""), (9, "c\n"), (5, "d"), (3, "  "), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in exact_dedupe(df).collect())
    assert got == [(2, "c"), (4, "a b"), (5, "d")]


def test_exact_dedupe_keeps_columns_and_groups(spark):
    df = spark.createDataFrame([(1, "x", 0, "p"), (2, "x", 1, "q"), (3, "x", 0, "r")], "doc_id long, text string, shard int, c string")
    assert sorted((r.doc_id, r.c) for r in exact_dedupe(df, group="shard").collect()) == [(1, "p"), (2, "q")]
    plan = exact_dedupe(df)._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan


def words(n, shift=0):
    return " ".join("w%d" % ((i + shift) % 997) for i in range(n))


def shingle_set(t):
    w = t.lower().split()
    if not w:
        return set()
    if len(w) < 3:
        return {" ".join(w)}
    return {" ".join(w[i:i + 3]) for i in range(len(w) - 2)}


NEAR = [
    words(50),                       # 0
    words(50) + " x1 x2",            # 1: just above 0.8 vs 0
    words(50) + " y1 y2 y3 y4 y5 y6 y7 y8 y9 y10",   # 2: below 0.8 vs 0
    words(40, 100),                  # 3  a
    words(40, 100) + " b1 b2",       # 4  b (a~b)
    words(40, 100) + " b1 b2 c1 c2",  # 5  c (b~c, a≁c?)
    "tiny text",                     # 6 shorter than 3 words
    "Tiny   text",                   # 7 same shingles as 6
    words(50),                       # 8 exact copy of 0
]


def brute_pairs(texts, t):
    reps = {}
    for i, x in enumerate(texts):
        s = x.strip()
        if s and s not in reps:
            reps[s] = i
    ids = sorted(reps.values())
    out = set()
    for a, b in itertools.combinations(ids, 2):
        A, B = shingle_set(texts[a]), shingle_set(texts[b])
        if A | B and len(A & B) / len(A | B) >= t:
            out.add((a, b, len(A & B), len(A | B)))
    return out


def test_similar_pairs_exact(spark):
    df = spark.createDataFrame(list(enumerate(NEAR)), "doc_id long, text string")
    got = {(r.a, r.b, r.inter, r.uni) for r in similar_pairs(df, 0.8).collect()}
    assert got == brute_pairs(NEAR, 0.8)
    lsh = {(r.a, r.b) for r in minhash_edges(df, 0.8).collect()}
    assert lsh <= {(a, b) for a, b, _, _ in got}


def test_threshold_that_doubles_cannot_hold(spark):
    common = [f"c{i}" for i in range(71)]
    a, b = common + [f"a{i}" for i in range(29)], common + [f"b{i}" for i in range(29)]
    # sets of single words via k = 1: 71 / 129
    df = spark.createDataFrame([(0, " ".join(a)), (1, " ".join(b))], "doc_id long, text string")
    assert [(r.inter, r.uni) for r in similar_pairs(df, 71 / 129, k=1).collect()] == [(71, 129)]
    df = spark.createDataFrame([(0, " ".join(f"w{i}" for i in range(100))), (1, " ".join(f"w{i}" for i in range(55)))],
                               "doc_id long, text string")
    assert [(r.inter, r.uni) for r in similar_pairs(df, 0.55, k=1).collect()] == [(55, 100)]


def test_lsh_finds_pairs_away_from_the_bucket_minimum(spark):
    # 0 is unlike the rest but shares its first words, hence many buckets
    base = words(200)
    rows = [(0, words(60) + " " + words(140, 500))] + [(i, base + f" t{i}") for i in range(1, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.a, r.b) for r in minhash_edges(df, 0.8, bands=20, rows=1).collect()]
    lab = {r.node: r.label for r in components(spark.createDataFrame(got, "a long, b long")).collect()}
    assert lab == {i: 1 for i in range(1, 30)}


def test_signature_bins_by_hand(spark):
    """Every bin against the rule: the smallest residue at or after the bin's
    start, else the smallest of all."""
    import zlib
    from quire.operators.dedupe import PRIME, signature_factors, signatures
    texts = ["", "one", "one two", "one two three", words(40), words(500) + " Ü ü", "a a a a a"]
    df = spark.createDataFrame(list(enumerate(texts)), "rep long, text string")
    for bins in (1, 7, 120):
        width, f = -(-PRIME // bins), signature_factors(3)
        got = {r.rep: list(r.sig) for r in signatures(df, 3, bins).collect() if r.sig}
        want = {}
        for i, t in enumerate(texts):
            c = [zlib.crc32(w.encode()) % PRIME for w in t.lower().split()]
            runs = [c[j:j + 3] for j in range(len(c) - 2)] if len(c) >= 3 else [c] if c else []
            h = {sum(a * b for a, b in zip(r, f)) % PRIME for r in runs}
            if h:
                want[i] = [min([v for v in h if v >= j * width], default=min(h)) for j in range(bins)]
        assert got == want


def test_lsh_without_a_candidate(spark):
    df = spark.createDataFrame([(0, "a b c d"), (1, "e f g h"), (2, None)], "doc_id long, text string")
    assert minhash_edges(df).collect() == []
    assert sorted(r.doc_id for r in near_dup_survivors(df).collect()) == [0, 1]


def test_components_and_survivors(spark):
    e = spark.createDataFrame([(1, 3), (2, 3), (5, 6), (7, 7)], "a long, b long")
    lab = {r.node: r.label for r in components(e).collect()}
    assert lab == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 7}
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r.label for r in components(chain).collect()} == {0}
    df = spark.createDataFrame(list(enumerate(NEAR)), "doc_id long, text string")
    keep = sorted(r.doc_id for r in near_dup_survivors(df, 0.8).collect())
    pairs = brute_pairs(NEAR, 0.8)
    adj = collections.defaultdict(set)
    for a, b, _, _ in pairs:
        adj[a].add(b)
        adj[b].add(a)
    reps = sorted({min(i for i, y in enumerate(NEAR) if y.strip() == x.strip()) for x in NEAR if x.strip()})
    exp = []
    for r in reps:
        stack, comp = [r], {r}
        while stack:
            for v in adj[stack.pop()]:
                if v not in comp:
                    comp.add(v)
                    stack.append(v)
        if min(comp) == r:
            exp.append(r)
    assert keep == exp


def test_language_id_separates(spark):
    from quire.operators.lang import detect_language, train_profile
    en = ["the cat sat on the mat with the hat", "this is the house that jack built", "where is the station"]
    fr = ["le chat est sur la table avec le chapeau", "ceci est la maison de jacques", "où est la gare"]
    rows = [(i, t, "en") for i, t in enumerate(en)] + [(10 + i, t, "fr") for i, t in enumerate(fr)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    prof, consts = train_profile(df)
    test = spark.createDataFrame([(100, "the hat is on the cat"), (101, "la gare est avec le chat")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in detect_language(test, prof, consts).collect()}
    assert got == {100: "en", 101: "fr"}


def test_bpe_matches_python(spark):
    from quire.operators.bpe import bpe_encode, train_bpe
    texts = ["low lower lowest newer wider", "new newest low low", "wide wider widest"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    m, v = train_bpe(df, 10)
    got = [(r.left, r.right) for r in m.orderBy("rank").collect()]
    wc = collections.Counter("▁" + w for t in texts for w in t.split())
    syms = {w: list(w) for w in wc}
    exp = []
    for _ in range(10):
        pc = collections.Counter()
        for w, s in syms.items():
            for a, b in zip(s, s[1:]):
                pc[(a, b)] += wc[w]
        best = sorted(pc.items(), key=lambda kv: (-kv[1], kv[0]))[0][0]
        exp.append(best)
        for w, s in syms.items():
            out = []
            for c in s:
                if out and out[-1] == best[0] and c == best[1]:
                    out[-1] = best[0] + best[1]
                else:
                    out.append(c)
            syms[w] = out
    assert got == exp
    inv = {r.id: r.token for r in v.collect()}
    enc = {r.doc_id: "".join(inv[i] for i in r.input_ids) for r in bpe_encode(df, m, v).collect()}
    assert enc == {i: "".join("▁" + w for w in t.split()) for i, t in enumerate(texts)}


def test_bpe_rounds_take_several_merges_and_stay_exact(spark):
    import random
    from quire.operators import bpe as B
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9))) for _ in range(150)]
    text = " ".join(rnd.choices(words, [1 / (i + 1) for i in range(150)], k=3000))
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    m, v = B.train_bpe(df, vocab_size=80)
    got = [(r.left, r.right) for r in m.orderBy("rank").collect()]
    assert v.count() <= 80 and len(got) > 50
    count = collections.Counter("▁" + w for w in text.split())
    split = {w: list(w) for w in count}
    for pair in got:                                   # every merge is the best one of its moment
        pairs = collections.Counter()
        for w, s in split.items():
            for p in zip(s, s[1:]):
                pairs[p] += count[w]
        assert pair == min(pairs, key=lambda p: (-pairs[p], p))
        for w, s in split.items():
            i = 0
            while i < len(s) - 1:
                if (s[i], s[i + 1]) == pair:
                    s[i:i + 2] = ["".join(pair)]
                i += 1


def test_registered_bpe_queries_train_the_whole_vocabulary(spark, monkeypatch):
    import pytest
    from quire.plans import catalog
    sizes = []

    def train(docs, num_merges=None, text="text", vocab_size=None):
        sizes.append((num_merges, vocab_size))
        raise StopIteration

    monkeypatch.setattr(catalog, "train_bpe", train)
    monkeypatch.setattr(catalog, "T", lambda *_: spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    for name in ("bpe_train", "bpe_encode"):
        with pytest.raises(StopIteration):
            catalog.QUERIES[name](spark, "")
    assert sizes == [(None, 32_000)] * 2


def test_language_of_rows_that_share_a_key(spark, monkeypatch):
    """Row by row, the same with a broadcast and a joined profile."""
    from quire.operators import lang as L
    train = spark.createDataFrame([("en", "the cat and the dog with that"), ("de", "der hund und die katze nicht auch")], "lang string, text string")
    rows = [(1, "the dog"), (1, "die katze"), (2, None), (3, ""), (4, "THE\u2003AND that"), (4, "THE\u2003AND that"), (None, "auch nicht")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    prof, consts = L.train_profile(train)
    key = lambda r: (str(r.doc_id), r.lang_pred, round(r.score, 6))                # noqa: E731
    one = sorted(map(key, L.detect_language(d, prof, consts).collect()))
    assert [k[:2] for k in one] == sorted([("1", "de"), ("1", "en"), ("2", "de"), ("3", "de"), ("4", "en"), ("4", "en"), ("None", "de")])
    plan = L.detect_language(d, prof, consts)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    monkeypatch.setattr(L, "BROADCAST_PROFILE_ROWS", 0)
    assert sorted(map(key, L.detect_language(d, prof, consts).collect())) == one


def test_forecast_errors_cost_rounds_not_exactness(spark, monkeypatch):
    """A forecast from three words, two pairs and small steps gives the same merges."""
    import random
    from quire.operators import bpe as B
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randrange(1, 8))) for _ in range(60)] + ["aaaaaaa", "é😀é😀"]
    df = spark.createDataFrame([(i, " ".join(rnd.choices(words, k=40))) for i in range(30)] + [(99, None)], "doc_id long, text string")
    whole = [tuple(r) for r in B.train_bpe(df, num_merges=60)[0].orderBy("rank").collect()]
    for name, value in (("FORECAST", 3), ("TOP", 2), ("STEPS", (4, 16)), ("HELD", 5)):
        monkeypatch.setattr(B, name, value)
    assert [tuple(r) for r in B.train_bpe(df, num_merges=60)[0].orderBy("rank").collect()] == whole
    # one by one
    count = collections.Counter("▁" + w for r in df.collect() if r.text for w in r.text.split())
    split = {w: list(w) for w in count}
    for _, left, right in whole:
        pairs = collections.Counter()
        for w, s in split.items():
            for p in zip(s, s[1:]):
                pairs[p] += count[w]
        assert (left, right) == min(pairs, key=lambda p: (-pairs[p], p))
        for s in split.values():
            i = 0
            while i < len(s) - 1:
                if (s[i], s[i + 1]) == (left, right):
                    s[i:i + 2] = [left + right]
                i += 1


def test_encode_keeps_rows_apart(spark):
    from quire.operators import bpe as B
    df = spark.createDataFrame([(1, "a b"), (1, "b\u2003c"), (2, None), (3, "zz \x00")], "doc_id long, text string")
    m, v = B.train_bpe(df.where("doc_id = 1"), num_merges=3)
    got = B.bpe_encode(df, m, v).collect()
    inv = {r.id: r.token for r in v.collect()}
    assert sorted((r.doc_id, "".join(inv.get(i, "?") for i in r.input_ids)) for r in got) == [(1, "▁a▁b"), (1, "▁b▁c"), (2, ""), (3, "▁??▁?")]


def test_exact_join_stores_only_shingles_of_several_sets(spark, monkeypatch):
    """Shingles of one set leave the job after they were counted; sets without enough others, too."""
    from quire.operators import dedupe as D
    texts = [" ".join(f"u{i}x{j}" for j in range(40)) for i in range(20)] + [words(50), words(50) + " z1 z2"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    reps, stored, keep = D.representatives(df), [], D.materialize
    monkeypatch.setattr(D, "materialize", lambda x: stored.append(keep(x)) or stored[-1])
    got = [tuple(r) for r in D.similar_pairs(df, 0.8, reps=reps).collect()]
    assert got == [(20, 21, 48, 50)]
    # stored are the sets, the prefixes (of sets that can have a partner) and the candidates
    assert [(r.a, r.b) for r in stored[2].collect()] == [(20, 21)]
    assert {r.rep for r in stored[1].collect()} == {20, 21}


def _by_hand(count, merges):
    """Trains word by word; True if every merge is the best one of its moment."""
    split = {w: list("▁" + w) for w in count}
    for pair in merges:
        pairs = collections.Counter()
        for w, s in split.items():
            for p in zip(s, s[1:]):
                pairs[p] += count[w]
        if pair != min(pairs, key=lambda p: (-pairs[p], p)):
            return False
        for s in split.values():
            i = 0
            while i < len(s) - 1:
                if (s[i], s[i + 1]) == pair:
                    s[i:i + 2] = ["".join(pair)]
                i += 1
    return True


def test_bpe_rounds_stay_few_when_word_types_exceed_the_driver(spark, monkeypatch):
    """Runs of the round's pairs, not whole word types, decide what a round can take."""
    import random
    from quire.operators import bpe as B
    monkeypatch.setattr(B, "FORECAST", 300)
    rnd = random.Random(11)
    stems = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randrange(2, 6))) for _ in range(60)]
    words = list({rnd.choice(stems) + rnd.choice(stems) + rnd.choice("aeiou") * rnd.randrange(3) for _ in range(1500)})
    text = [" ".join(rnd.choices(words, k=500)) for _ in range(20)]
    stats: dict = {}
    m, _ = B.train_bpe(spark.createDataFrame(list(enumerate(text)), "doc_id long, text string"), num_merges=150, stats=stats)
    got = [(r.left, r.right) for r in m.orderBy("rank").collect()]
    count = collections.Counter(w for t in text for w in t.split())
    assert len(count) > 4 * B.FORECAST and len(got) == 150
    assert _by_hand(count, got)
    assert stats["rounds"] <= 15


def test_bpe_many_equal_counts_take_one_round(spark):
    from quire.operators import bpe as B
    text = " ".join(f"{chr(0x4E00 + i)}{chr(0x5E00 + i)}" for i in range(300))           # each pair once
    stats: dict = {}
    m, _ = B.train_bpe(spark.createDataFrame([(0, text)], "doc_id long, text string"), num_merges=200, stats=stats)
    assert _by_hand(collections.Counter(text.split()), [(r.left, r.right) for r in m.orderBy("rank").collect()])
    assert stats == {"rounds": 1, "merges": 200}


def test_encoder_merges_the_new_words_of_a_batch_together():
    import random
    from quire.operators import bpe as B
    rnd = random.Random(5)
    words = ["".join(rnd.choices("ab\x00é😀", [6, 6, 1, 1, 1], k=rnd.randrange(1, 14))) for _ in range(300)] + ["a" * 9, "zz"]
    pairs = [("a", "a"), ("▁", "a"), ("a", "b"), ("aa", "aa"), ("b", "aa"), ("é", "b"), ("▁a", "b"), ("aa", "a"), ("ab", "ab"), ("b", "b")]
    ids = {t: i for i, t in enumerate(dict.fromkeys([*"▁abé", *(l + r for l, r in pairs)]))}
    enc = B.Encoder({p: r for r, p in enumerate(pairs)}, ids, -1)
    for part in (words[:150], words[100:]):
        enc.learn(part)
    for w in words:
        s = list("▁" + w)
        while ranked := [pairs.index(p) for p in zip(s, s[1:]) if p in pairs]:
            pair, i = pairs[min(ranked)], 0
            while i < len(s) - 1:
                if (s[i], s[i + 1]) == pair:
                    s[i:i + 2] = ["".join(pair)]
                i += 1
        assert enc[w] == [ids.get(t, -1) for t in s], w


def test_lsh_settles_many_unlike_texts_of_a_bucket_in_few_rounds(spark, monkeypatch):
    """The links of one head after the other, but several heads a round, also where near copies stand side by side."""
    from quire.operators import dedupe as D
    common = " ".join(f"c{i}" for i in range(70))
    texts = [f"{common} " + " ".join(f"u{i // 3}x{j}" for j in range(25)) + " " + " ".join(f"e{i}y{j}" for j in range(2 * (i % 3))) for i in range(90)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    reps = D.representatives(df)
    sig = {r.rep: r.sig for r in D.signatures(reps, 3, 4).collect()}
    sets = {r.rep: set(r.s) for r in D.shingle_sets(reps).collect()}
    buckets = collections.defaultdict(list)
    for rep in sorted(sig):
        for band in range(4):
            buckets[band, sig[rep][band]].append(rep)
    expected, most = set(), 0
    for x in buckets.values():
        heads = 0
        while len(x) > 1:
            head, like = x[0], [b for b in x[1:] if len(sets[x[0]] & sets[b]) / len(sets[x[0]] | sets[b]) >= 0.8]
            expected |= {(head, b, len(sets[head] & sets[b]), len(sets[head] | sets[b])) for b in like}
            x, heads = [b for b in x[1:] if b not in like], heads + 1
        most = max(most, heads)
    assert most >= 20 and expected
    for pairs, rounds in ((40_000, 2), (0, 7)):
        stored, keep = [], D._verify
        monkeypatch.setattr(D, "HEAD_PAIRS", pairs, raising=False)
        with monkeypatch.context() as m:
            m.setattr(D, "_verify", lambda *a: stored.append(1) or keep(*a))
            got = D.minhash_edges(df, 0.8, bands=4, rows=1, reps=reps).collect()
        assert len(got) == len(expected) and {tuple(r) for r in got} == expected
        assert len(stored) <= rounds


def test_exact_pairs_shuffle_little_for_shingles_of_one_set(spark):
    """Shingles of one set only are told apart before the sets are shuffled; those of
    several sets all stay, in one task or in several."""
    from quire.operators import dedupe as D
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(40)]
    rows += [(100 + i, rows[i][1] + " tail") for i in range(0, 40, 8)] + [(200, "one two"), (201, "one  two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = D.shingle_sets(D.representatives(df))
    for total in (1, 5000, 10**9):
        some = {r.rep: (r._n, set(r.s)) for r in D.maybe_shared(sets, total).collect()}
        whole = {r.rep: set(r.s) for r in sets.collect()}
        assert {k: len(v) for k, v in whole.items()} == {k: n for k, (n, _) in some.items()}
        df_ = {}
        for v in whole.values():
            for h in v:
                df_[h] = df_.get(h, 0) + 1
        assert all({h for h in whole[k] if df_[h] > 1} <= v <= whole[k] for k, (_, v) in some.items())
    assert sum(len(v) for _, v in some.values()) < sum(map(len, whole.values())) / 2
    got = sorted(tuple(r) for r in D.similar_pairs(df, 0.8).collect())
    assert got == [(i, 100 + i, 58, 59) for i in range(0, 40, 8)] + [(200, 201, 1, 1)]
