"""Operators with Python tasks, against brute force, the libraries and held-out labels."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from stratamart.llm import bitplanes, char_models, covering, prefix_counts, pu_quality, templates, transcripts
from stratamart.llm.components import components
from stratamart.llm.word_ids import WordIds

ODD = "aZ é’'\n\t\r0123,.!?<|>ΣςİßÁ　\x85\xa0\x1c​中文👍#$%re▁  the\x00H̱क़"


def odd_texts(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice(ODD) for _ in range(pick.randint(0, 24))) + pick.choice(["", "<|endoftext|>", " <|startoftext|>x", "'s.", "Σ Σ"]) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "doc") for i, t in enumerate(odd_texts(60, 1))] + [(5, "again", "doc"), (5, "again", "doc"), (None, "no id", "doc"), (900, None, "doc"), (901, "word " * 30_000, "doc")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, fp string")


# ---- 1: bit planes


@pytest.mark.parametrize("bits", [1, 8])
def test_blocks_round_trip(bits):
    pick = np.random.default_rng(1)
    for ids in (np.array([0]), np.array([2**32 - 1, 0]), pick.integers(0, 2**32, 1000), pick.integers(0, 49408, 65_536)):
        ends, payload = bitplanes.pack(ids.astype("<u4"), bits)
        assert (bitplanes.unpack(len(ids), bits, ends, payload) == ids).all()


def test_crc_parts_xor_to_the_whole():
    data = random.Random(2).randbytes(10_000)
    cuts = [0, 7, 8, 4000, 10_000]
    whole = 0
    for a, b in zip(cuts, cuts[1:]):
        whole ^= bitplanes.crc_part(data[a:b], len(data) - b)
    assert whole == zlib.crc32(data)


def test_word_ids_equal_the_library():
    words = WordIds(public_tokenizers.path(bitplanes.VOCABULARY))
    for t in odd_texts(3000, 4):
        assert words.encode(t).tolist() == words.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("bits,block", [(1, 64), (8, 1000)])
def test_token_files_round_trip(spark, odd, tmp_path, bits, block):
    path = str(tmp_path / "ids")
    bitplanes.write(odd, path, bitplanes.word_encoder(), bits=bits, block=block)
    tokenizer = WordIds(public_tokenizers.path(bitplanes.VOCABULARY)).tokenizer
    want, start = [], 0
    for r in sorted(odd.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        want.append((r["doc_id"], start, ids))
        start += len(ids)
    parts = {}
    for r in bitplanes.read(spark, path).orderBy("start", "skip").collect():
        parts.setdefault((r["doc_id"], r["start"]), []).extend(r["ids"])
    assert sorted(map(str, ((k[0], v) for k, v in parts.items()))) == sorted(map(str, ((i, ids) for i, _, ids in want)))
    got = sorted(bitplanes.digests(spark, path).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in got] == list(np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]))
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert sorted(str((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in got) == sorted(str((i, len(x), crc(x))) for i, _, x in want)


def test_token_query_starts_in_order_of_ids(spark, docs):
    tokenizer = WordIds(public_tokenizers.path(bitplanes.VOCABULARY)).tokenizer
    start = 0
    got = {r["doc_id"]: (r["start"], r["n_tokens"]) for r in bitplanes.op1(docs).collect()}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        n = len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
        assert got[r["doc_id"]] == (start, n)
        start += n


# ---- 2: templates

QUESTION = "Maria buys 12 apples at $3 each and then sells 5 of them to Carlos for $4 each. How much money does she have left?"


def test_templates_catch_copies_and_consistent_rewording_only(spark):
    rows = [
        (1, "Intro. " + QUESTION + " Outro."), (2, QUESTION.replace("12", "31").replace("5 of", "8 of").replace("Carlos", "Hanna").replace("$3", "$7").replace("$4", "$9")),
        (3, "Maria buys 31 apples at $31 each and then sells 31 of them to Maria for $31 each. How much money does she have left?"),
        (4, "Nothing of the kind is said here, and 12 apples cost $3."), (5, None), (6, ""), (None, QUESTION), (1, "Intro. " + QUESTION + " Outro."),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(7, QUESTION), (8, None), (9, "too short"), (10, "five plain words stand here")], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["reworded"] for r in templates.op2(docs, items).collect()}
    assert got == {(1, 7): False, (2, 7): True, (None, 7): False}
    assert sorted(r["doc_id"] for r in templates.clean(docs, items).collect()) == [3, 4, 5, 6]
    assert templates.op2(docs, items.filter("false")).count() == 0 and templates.op2(docs.filter("false"), items).count() == 0


def test_templates_against_brute_force(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in templates.op2(docs, items).collect()}
    flat = lambda t: " " + " ".join(t.lower().split()) + " "
    want = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if flat(i["text"]) in flat(d["text"])}
    assert want <= got
    extra = {d for d, _ in got - want}
    held = {r["doc_id"]: set(flat(r["text"]).split()) for r in docs.collect()}
    words = {r["item_id"]: set(flat(r["text"]).split()) for r in items.collect()}
    assert all(len(held[d] & words[i]) >= 0.8 * len(words[i]) for d, i in got - want), extra


# ---- 4: transcripts


def test_markers_and_rendering(spark):
    rows = [(1, 0, None, "System: be brief\nUser: hello\nthere?\nAssistant: yes\nHuman: more\nAI: ok"), (2, 0, None, None), (2, 0, None, ""), (None, 1, None, "Q: why?\nA: so")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = transcripts.op4(table).filter("conv_id = 1").orderBy("block").collect()
    assert [r["role"] for r in got] == ["system", "user", "assistant", "user", "assistant"]
    assert got[1]["rendered"] == "<|user|>\nhello\nthere?"
    assert [r["role"] for r in transcripts.op4(table).filter("conv_id is null").orderBy("block").collect()] == ["user", "assistant"]
    assert transcripts.op4(table).filter("conv_id = 2").count() == 2 and transcripts.op4(table.filter("false")).count() == 0


def test_roles_of_held_out_conversations_and_of_one_conversation_over_many_tasks(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = transcripts.op4(table).filter(transcripts.fold(F.col("conv_id"), transcripts.FOLDS) == transcripts.HELD_OUT).collect()
    assert np.mean([r["role"] == r["role_given"] for r in got]) > 0.95
    model = transcripts.train(transcripts._sorted(table))
    one = table.select(F.lit(1).cast("bigint").alias("conv_id"), (F.col("conv_id") * 100 + F.col("turn")).alias("turn"), "role", "text")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = []
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append(sorted((r["turn"], r["role"], r["new_turn"]) for r in transcripts.parse(one, model).collect()))
    for k, v in kept.items():
        spark.conf.set(k, v)
    assert found[0] == found[1]


# ---- 6: covering


def test_every_pair_within_the_radius_meets():
    pick = random.Random(6)
    for _ in range(2000):
        flipped = sum(1 << p for p in pick.sample(range(64), 3))
        assert any(m & flipped == 0 for m in covering.FIRST)
        table = next(i for i, m in enumerate(covering.FIRST) if m & flipped == 0)
        assert any(s & flipped == 0 for s in covering.SECOND[table])
    assert covering.second_level_free() <= 16


def brute_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_groups_against_brute_force(spark, docs, odd):
    rows = docs.select("doc_id", "text").union(odd.filter("doc_id <> 5").select(F.col("doc_id") + 1000, "text"))
    near = spark.createDataFrame([(5000 + i, " ".join(f"w{j}" for j in range(800)) + f" tail{i}") for i in range(40)], "doc_id bigint, text string")
    got = covering.op6(rows.union(near)).filter("doc_id is not null").collect()
    texts = {r["doc_id"]: r["text"] for r in rows.union(near).collect() if r["doc_id"] is not None}
    prints = {i: brute_print(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 3 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert all((r["fingerprint"], r["component_id"]) == (f"{prints[r['doc_id']]:016x}", find(r["doc_id"])) for r in got)


def test_large_buckets_are_split_and_lose_nothing(spark):
    pick = random.Random(8)
    centre = pick.getrandbits(64)
    values = {centre}
    for _ in range(600):
        values.add(pick.choice(sorted(values)) ^ sum(1 << p for p in pick.sample(range(64), pick.choice([1, 2, 3, 5]))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    found = [{r["node"]: r["root"] for r in components(covering.links(table, split)).collect()} for split in (2, 16, 4096)]
    assert found[0] == found[1] == found[2]
    links = covering.forest(np.array(sorted(values), dtype=np.uint64))
    assert len({(a, b) for a, b in links}) == len(links)


def test_one_row_per_group_stays(spark):
    text = " ".join(f"w{j}" for j in range(300))
    rows = [(3, text, "a", "keep"), (2, text, "b", "keep"), (2, text, "b", "keep"), (9, "other words here", "c", "keep"), (None, text, "d", "keep"), (7, None, "e", "keep"), (8, "", "e", "keep")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, root string")
    kept = covering.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["fp"]) for r in kept.collect()) == [(2, "b"), (7, "e"), (9, "c")]
    assert covering.op6(docs.filter("false")).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in components(chain).collect()} == {0}


# ---- 7: languages


def test_languages_of_held_out_documents(spark, odd):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = char_models.op7(table).filter("held_out").join(table.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got if r["n"] > 40]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_odd_rows(spark, odd):
    assert {r["lang_pred"] for r in char_models.predictions(odd, None).collect()} == {"und"}
    taught = spark.createDataFrame([(i, "the cat and the dog", "en", "x") for i in range(20)] + [(i, "der hund und die katze", "de", "x") for i in range(20)], "doc_id bigint, text string, lang string, score string")
    model = char_models.train(taught)
    asked = spark.createDataFrame([(1, "the dog"), (2, "die katze"), (3, None), (4, "12 !!"), (5, "漢字漢字漢字")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in char_models.predictions(asked, model).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 5)] == ["en", "de", "und", "und"] and not got[5]["accepted"]
    assert char_models.train(taught.filter("false")) is None


def test_model_probabilities_sum_to_one(spark):
    taught = spark.createDataFrame([(i, "abc abd bcd the cat and", "en") for i in range(20)], "doc_id bigint, text string, lang string")
    model = char_models.train(taught)
    # Over the seen alphabet, what follows a context takes all but the uniform rest.
    letters = sorted({g for g in "abcdthen\0"})
    whole = sum(float(np.exp(model.logs([f"ab{c}"])[0, 0])) for c in letters if c != "\0")
    assert 0 < whole < 1


# ---- 8: counts


def test_counts_and_prefixes_equal_the_library():
    import sentencepiece

    path = public_tokenizers.path(prefix_counts.VOCABULARY)
    library, counter = sentencepiece.SentencePieceProcessor(model_file=path), prefix_counts.PrefixCounter(path)
    for k, t in enumerate(odd_texts(3000, 9)):
        assert counter.count(t) == len(library.encode(t)), repr(t)
        if k % 20 == 0:
            every = counter.every_prefix(t).tolist()
            assert every == [len(library.encode(t[:i])) for i in range(len(t) + 1)]
            for budget in (0, 1, 4, 9):
                assert counter.fitting(t, budget) == max(i for i, n in enumerate(every) if n <= budget)


def test_prefix_table_answers_questions(spark, odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(prefix_counts.VOCABULARY))
    rows = odd.filter("doc_id < 40 and text <> 'again'")
    table = prefix_counts.prefix_table(rows, block=8)
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    asked = spark.createDataFrame([(i, n) for i, t in texts.items() for n in (0, len(t) // 2, len(t))], "doc_id bigint, chars bigint")
    got = prefix_counts.tokens_of_prefix(table, asked).collect()
    assert len(got) == 3 * len(texts) and all(r["n_tokens"] == len(library.encode(texts[r["doc_id"]][: r["chars"]])) for r in got)
    for r in prefix_counts.longest_prefix(table, 5).collect():
        t = texts[r["doc_id"]]
        assert r["chars"] == max(i for i in range(len(t) + 1) if len(library.encode(t[:i])) <= 5)
    counts = {(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in prefix_counts.op8(odd).collect()}
    assert counts == {(r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or ""))) for r in odd.collect()}


# ---- 9: quality


def test_quality_of_held_out_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = pu_quality.op9(table.join(labels.select("doc_id").distinct(), "doc_id", "left_semi"), labels).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.97
    assert np.mean([r["predicted"] for r in got if r["quality"] == 1]) > 0.99


def test_prior_estimate_and_odd_rows(spark, odd):
    pick = np.random.default_rng(3)
    positive, negative = pick.normal(2, 1, (4000, 1)), pick.normal(-2, 1, (3000, 1))
    mixed = np.vstack([pick.normal(2, 1, (7000, 1)), negative])
    assert abs(pu_quality.estimate_prior(positive[:, 0], mixed[:, 0]) - 0.7) < 0.05
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1)], "doc_id bigint, quality int")
    got = pu_quality.op9(odd, labels)
    assert got.count() == odd.count() and all(0 <= r["score"] <= 1 for r in got.collect())
    assert {r["score"] for r in pu_quality.op9(odd, labels.filter("false")).collect()} == {0.5}


# ---- all: empty tables and foreign columns


def test_operators_on_empty_tables(spark, docs):
    none = docs.filter("false")
    conversations = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").filter("false")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    made = [
        bitplanes.op1(none), templates.op2(none, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")), transcripts.op4(conversations), covering.op6(none),
        char_models.op7(none), prefix_counts.op8(none), pu_quality.op9(none, labels), pu_quality.op9(none, labels.filter("false")),
    ]
    assert [m.count() for m in made] == [0] * len(made)


def test_operators_ignore_columns_that_share_their_names(spark):
    rows = [(i, f"the quick brown fox number {i} jumps over the dog", "en", "s", "x", "x", "x", "x") for i in range(12)]
    names = "doc_id bigint, text string, lang string, source string, text_hash string, entropy string, n_bytes string, x string"
    table = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([(1, 1, "x")], "doc_id bigint, quality int, text string")
    items = spark.createDataFrame([(1, rows[3][1], "x")], "item_id bigint, text string, hash string")
    assert {m.count() for m in (bitplanes.op1(table), covering.op6(table), char_models.op7(table), prefix_counts.op8(table), pu_quality.op9(table, labels))} == {12}
    assert {r["doc_id"] for r in templates.op2(table, items).collect()} >= {3}


def test_kneser_ney_equals_a_plain_recursion(spark):
    """Probabilities of the sorted table against the textbook recursion over dictionaries, single n-grams included."""
    from collections import Counter

    words = {"xx": ["abab", "ab", "abba", "baab", "abc"], "yy": ["cab", "acca", "bca", "abc"]}
    rows = [(i, k, " ".join(w)) for i, (k, w) in enumerate((k, [w]) for k in words for w in words[k] for _ in range(8))]
    table = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = char_models.train(table, held_out=99)
    apart = F.pmod(F.xxhash64(F.lit(13), "doc_id", "text"), F.lit(char_models.CALIBRATION)) == 0
    learnt = [(r["lang"], r["text"]) for r in char_models.sample(table, held_out=99).filter(~apart).collect()]
    order, discount = char_models.ORDER, char_models.DISCOUNT

    def probability(lang):
        grams = [Counter() for _ in range(order + 1)]
        before = [{} for _ in range(order + 1)]
        for k, w in learnt:
            if k == lang:
                s = char_models._padded(w)
                for end in range(order, len(s) + 1):
                    for n in range(1, order + 1):
                        g = s[end - n : end]
                        grams[n][g] += 1
                        before[n].setdefault(g, set()).add(s[end - n - 1] if n < order else "")

        def mass(g):
            return grams[order][g] if len(g) == order else len(before[len(g)].get(g, ()))

        def p(context, c):
            g = context + c
            if not g:
                return char_models.UNIFORM
            same = [x for x in grams[len(g)] if x[:-1] == context]
            total = sum(mass(x) for x in same)
            lower = p(context[1:], c) if context else char_models.UNIFORM
            if not total:
                return lower
            return max(mass(g) - discount, 0) / total + discount * len(same) / total * lower

        return p

    for lang in words:
        p, column = probability(lang), model.languages.index(lang)
        for w in ["abab", "cab", "zz", "abcabc", "b"]:
            s = char_models._padded(w)
            want = sum(np.log(p(s[end - order : end - 1], s[end - 1])) for end in range(order, len(s) + 1))
            assert abs(model.logs([w])[0][column] - want) < 1e-9, (lang, w)


def test_rows_without_id_teach_no_quality(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    noise = spark.createDataFrame([(None, "@@@ ### !!!" * 30)] * 2000, "doc_id bigint, text string")
    model = pu_quality.train(table.select("doc_id", "text"), labels)
    with_noise = pu_quality.train(table.select("doc_id", "text").union(noise), labels)
    assert model.prior == with_noise.prior and np.array_equal(model.centre, with_noise.centre)
    repeated = table.select("doc_id", "text").union(table.filter("doc_id = 1").select("doc_id", "text").crossJoin(spark.range(500)).select("doc_id", "text"))
    assert abs(pu_quality.train(repeated, labels).prior - model.prior) < 0.2


def test_the_longest_prefix_of_a_budget_counts_no_word_behind_it(monkeypatch):
    import public_tokenizers
    from stratamart.llm import prefix_counts

    counter = prefix_counts.PrefixCounter(public_tokenizers.path(prefix_counts.VOCABULARY))
    text = " ".join(f"word{k}" for k in range(500))
    every, asked, total = counter.every_prefix(text), [], counter.total
    monkeypatch.setattr(counter, "total", lambda chunk: asked.append(chunk) or total(chunk))
    for budget in (0, 1, 7, 20):
        assert counter.fitting(text, budget) == max(i for i, n in enumerate(every) if n <= budget)
    assert len(asked) <= 22
