import random

import pytest

from calipers.llm import ngram_join
from corpus_cases import documents, empty


def brute(docs, percent=80, size=5):
    sets = []
    for _, t in docs:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
        sets.append(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset())
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(docs):
        ids.setdefault(find(k), []).append(i)
    low = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return sorted(((i, len(s), low[find(k)]) for k, ((i, _), s) in enumerate(zip(docs, sets))), key=str)


@pytest.mark.parametrize("frequent", [2, 6, 1000])
def test_against_all_pairs(spark, frequent):
    """Groups of near copies, shared passages and short texts, whatever counts as frequent."""
    random.seed(frequent)
    vocabulary = [f"w{k}" for k in range(400)]
    draw = lambda n: [random.choice(vocabulary) for _ in range(n)]
    passage, docs = draw(25), []
    for size in (6, 12, 40, 90, 130, 300):
        base = draw(size)
        for _ in range(12):
            own = list(base)
            for _ in range(random.randint(0, max(1, size // 60))):
                own[random.randrange(len(own))] = random.choice(vocabulary)
            docs.append(" ".join(own[: len(own) - random.randint(0, 3)]))
    docs += [" ".join(draw(20) + passage + draw(20)) for _ in range(10)] + [" ".join(passage + draw(3)) for _ in range(10)]
    docs += [" ".join(draw(random.randint(0, 6))) for _ in range(20)] + docs[:5] + ["A b C d e f", "a B c d\ne f", "\x1ca b c d e", None, ""]
    rows = list(enumerate(docs))
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.similar(df, frequent=frequent).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_cases(spark):
    got = sorted(map(tuple, ngram_join.similar(documents(spark)).collect()), key=str)
    want = brute([(r["doc_id"], r["text"]) for r in documents(spark).collect()])
    assert got == want
    assert ngram_join.similar(empty(spark)).count() == 0


def test_prefixes_hold_enough_shared_tokens():
    for n in range(1, 400):
        need = -(-80 * n // 100)
        for k in (1, 2):
            assert ngram_join.prefix_length(n, k) == min(n, n - need + k)


def test_sketches_never_differ_more_than_the_sets():
    import numpy as np

    rng = np.random.default_rng(2)
    for n, m, shared in ((10, 12, 5), (300, 260, 250), (256, 255, 200), (2000, 1000, 900), (5000, 5200, 4900), (1, 1, 0)):
        tokens = np.unique(rng.integers(0, 1 << 63, size=n + m, dtype=np.uint64) * np.uint64(2))
        x, y = np.sort(tokens[:n]), np.sort(np.concatenate([tokens[:shared], tokens[n : n + m - shared]]))
        unlike = ngram_join.unlike_bits(ngram_join.sketch(x), ngram_join.sketch(y))
        assert unlike <= len(np.setxor1d(x, y))


def test_a_group_of_unlinked_near_copies_is_not_compared_whole(spark, monkeypatch):
    """Texts with a shared half, which no link joins: few of their pairs are verified, in whatever rounds, and links stay."""
    random.seed(5)
    shared = [f"s{k}" for k in range(60)]
    docs = [" ".join(shared + [f"d{i}x{k}" for k in range(14)]) for i in range(60)]
    docs += [t + " more" for t in docs[::20]]
    rows = list(enumerate(docs))
    pairs = []
    monkeypatch.setattr(ngram_join, "PROPOSERS", 2)
    monkeypatch.setattr(ngram_join, "verified", lambda p, *a, f=ngram_join.verified: pairs.append(p.count()) or f(p, *a))
    got = ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), frequent=6).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert len(pairs) > 3 and sum(pairs) < 4 * len(rows), pairs


def test_only_chosen_texts_are_cut_again(spark):
    """A text is known by its hash: the rest are not cut into shingles, and a pass without pairs reads none."""
    import numpy as np
    import pyarrow as pa

    texts = [" ".join(f"t{i}w{k}" for k in range(20)) for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"text": texts + texts[:3], "x": np.array([(i * 2**58 // 3) for i in [*range(40), 0, 1, 2]], dtype=np.int64)})
    packed = np.zeros((1 << ngram_join.BITS) // 8, dtype=np.uint8)
    for i in (1, 7):
        bit = int(batch.column(1)[i].as_py()) >> (64 - ngram_join.BITS)
        packed[bit >> 3] |= 1 << (7 - (bit & 7))
    got = [h for h, _ in ngram_join._chosen_sets(iter([batch]), packed, 5)]
    sets = list(ngram_join.shingle_sets(pa.array(texts)))
    assert got == [ngram_join.handle(sets[i]) for i in (1, 7)]
    none = spark.createDataFrame([], "a long, b long")
    assert ngram_join.verified(none, None, None).collect() == []


def test_grown_components_equal_merged_ones(spark):
    random.seed(3)
    for n, more in ((30, 0), (30, 12), (80, 60)):
        edges = [(random.randrange(n), random.randrange(n)) for _ in range(n // 2)]
        comps = ngram_join.components(spark.createDataFrame([e for e in edges if e[0] != e[1]], "a long, b long"))
        links = spark.createDataFrame([(random.randrange(2 * n), random.randrange(2 * n)) for _ in range(more)], "a long, b long").filter("a <> b")
        groups = lambda df: sorted(sorted(r["h"] for r in df.collect() if r["comp"] == c) for c in {r["comp"] for r in df.collect()})
        assert groups(ngram_join.grown(comps, links)) == groups(ngram_join.merged(comps, links))


def test_a_bitmap_is_one_job_whatever_the_partitions(spark):
    """Bits come back in one job, not in one for each partition."""
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    bits = [k * 40_009 for k in range(1500)]
    rows = spark.createDataFrame([(b,) for b in bits], "bit int").repartition(4)
    before, adaptive = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        context.setJobGroup("bitmap", "bitmap")
        packed = ngram_join._bitmap(rows, "bit")
    finally:
        context._jsc.clearJobGroup()
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    import numpy as np

    assert np.flatnonzero(np.unpackbits(packed)).tolist() == bits
    assert len(tracker.getJobIdsForGroup("bitmap")) < 10


def test_tokens_are_counted_alike_however_few_are_dealt_at_a_time(spark, monkeypatch):
    """Sets are handed on in arrays of RANGE_TOKENS or just more; the frequent tokens are the same."""
    import numpy as np

    texts = spark.createDataFrame([(" ".join(f"w{(i * 7 + k) % 90}" for k in range(40)),) for i in range(60)], "text string").repartition(3)
    want = ngram_join.frequent_tokens(texts, 2_000, least=5)
    monkeypatch.setattr(ngram_join, "RANGE_TOKENS", 50)
    assert want.any() and np.array_equal(ngram_join.frequent_tokens(texts, 2_000, least=5), want)
