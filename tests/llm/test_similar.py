"""The pipeline's near-duplicates against brute-force Jaccard similarity of five-word shingles."""

import random

import pytest

import corpus_pipeline
from stratamart.llm import similar


def brute_force(texts):
    """The least id of each group linked by a similarity of at least 0.8."""
    sets, root = {}, {i: i for i in texts}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return sorted({find(i) for i in ids})


def near_copies():
    """Texts with a common passage, near copies on either side of 0.8, chains of copies of copies, short and empty ones."""
    pick = random.Random(11)
    common = [f"c{k}" for k in range(20)]
    out = []
    for g in range(12):
        words = [f"g{g}w{pick.randint(0, 400)}" for _ in range(pick.choice([7, 40, 90, 200]))]
        for _ in range(8):
            words = list(words)
            for _ in range(pick.randint(0, max(1, len(words) // 40))):
                words[pick.randrange(len(words))] = f"x{pick.randint(0, 10**6)}"
            out.append(" ".join(common + words if g % 2 else words))
    return dict(enumerate([*out, None, "", " \n", "a b", "A b", "a c"]))


@pytest.mark.parametrize("limit", [1, similar.FREQUENT])
def test_stage_keeps_one_of_each_group_at_similarity_08(spark, monkeypatch, limit):
    monkeypatch.setattr(similar, "FREQUENT", limit)
    texts = near_copies()
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in got) == brute_force(texts)


def test_empty_documents_have_no_groups(spark):
    assert similar.groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_stage_on_supplied_documents(spark, small):
    docs = corpus_pipeline.good_quality(spark, corpus_pipeline.table(spark, small, "documents"), small)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, small).collect())
    assert got == brute_force(texts)
    assert len(got) < corpus_pipeline.covering.one_per_group(docs).count()  # three bits of three-word shingles miss some


def test_operator_6_links_the_fingerprints_of_the_sets(spark, monkeypatch):
    from stratamart.llm import covering

    asked, links = [], covering.links
    monkeypatch.setattr(covering, "links", lambda fps: asked.append(sorted(r["fp"] for r in fps.collect())) or links(fps))
    texts = near_copies()
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    memory = similar.WordHashes()
    assert asked == [sorted({similar.fingerprint(similar.shingles(t, memory)) for t in texts.values()})]
    assert sorted(r["doc_id"] for r in got) == brute_force(texts)


def test_frequent_shingles_are_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(60))) for i in range(4)], "doc_id bigint, text string")
    for limit in (0, 1, 20, 56, 100):
        monkeypatch.setattr(similar, "FREQUENT", limit)
        found, n = similar.frequent(docs)
        assert list(found) == sorted(found) and set(n) <= {4}
        assert len(found) == 56 if limit >= 56 else len(found) < 56


def test_frequent_shingles_come_without_a_sort_on_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "limit", lambda *a: pytest.fail("each part would send that many rows"))
    assert len(similar.frequent(spark.createDataFrame([(i, "a b c d e f") for i in range(3)], "doc_id bigint, text string"))[0]) == 2


def _sets_of(spark, texts):
    from stratamart.llm.common import stored

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return stored(similar.prefixes(docs).select("node", "n", "keys", "fp", "least", "sketch"))


def test_a_pair_leaves_about_once_where_it_meets(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    words = [f"w{k}" for k in range(600)]
    once = _sets_of(spark, [" ".join(words), " ".join(f"x{k}" if k % 60 == 9 else w for k, w in enumerate(words))])
    nobody, sketched = spark.createDataFrame([], "node bigint, root bigint"), similar.sketches(once)
    assert similar.pairs_apart(once, nobody, sketched).count() == 1
    monkeypatch.setattr(DataFrame, "distinct", lambda df: df)
    assert 1 <= similar.pairs_apart(once, nobody, sketched).count() <= 10  # 17 rows without looking at the shingles before


def test_long_texts_with_a_passage_in_common_are_told_apart_by_sketches(spark, monkeypatch):
    monkeypatch.setattr(similar, "FREQUENT", 0)
    pick = random.Random(5)
    common = [f"c{k}" for k in range(200)]
    once = _sets_of(spark, [" ".join(common + [f"w{pick.randint(0, 10**6)}" for _ in range(3000)]) for _ in range(12)])
    nobody = spark.createDataFrame([], "node bigint, root bigint")
    assert similar.pairs_apart(once, nobody, similar.sketches(once)).count() == 0


def test_finer_sketches_leave_every_similar_pair(spark):
    sizes = [255, 256, 257, 280, 2040, 2049, 2300, 4090, 4100, 4600, 8200]
    shared = [f"w{k}" for k in range(max(sizes))]
    once = _sets_of(spark, [" ".join(shared[: n + 4]) for n in sizes])
    nobody = spark.createDataFrame([], "node bigint, root bigint")
    want = {(m, n) for m in sizes for n in sizes if m < n and 5 * m >= 4 * n}
    n = {r["node"]: r["n"] for r in once.collect()}
    got = {tuple(sorted((n[r["a"]], n[r["b"]]))) for r in similar.pairs_apart(once, nobody, similar.sketches(once)).collect()}
    assert want <= got
    assert all(similar.sketch_bits(5 * k // 4) <= 2 * similar.sketch_bits(k) for k in range(40_000))


def test_a_family_of_near_copies_holds_together_by_its_first_links(spark):
    pick = random.Random(3)
    base = [f"w{k}" for k in range(400)]
    texts = [" ".join(f"x{pick.randint(0, 10**6)}" if pick.random() < 0.011 else w for w in base) for _ in range(60)]
    once = _sets_of(spark, texts)
    memory, sets = similar.WordHashes(), {}
    for found in (similar.shingles(t, memory) for t in texts):
        h = similar.xxhash.xxh64_intdigest(found.tobytes())
        sets[h - 2**64 if h >= 2**63 else h] = set(found.tolist())
    root = {x: x for x in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in similar.likely_pairs(once).collect():
        both = len(sets[r["a"]] & sets[r["b"]])
        if 9 * both >= 4 * (len(sets[r["a"]]) + len(sets[r["b"]])):
            root[find(r["a"])] = find(r["b"])
    assert len({find(x) for x in sets}) <= 4
