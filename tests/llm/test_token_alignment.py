"""Token groups, links and counts against a brute force over byte ranges, with the libraries' own tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import rows

from stratamart.llm import token_alignment
from stratamart.llm.common import table


@pytest.fixture(scope="module")
def tokens():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in plain)}

    def cut(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + text).encode()
        return (ids_a, ids_b, bytes_a, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else None

    return cut


def ranges(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute_force(documents, tokens):
    found, counts = [], Counter()
    for i, text in documents:
        cut = tokens(text)
        if cut is None:
            found.append((i, None))
            continue
        ids_a, ids_b, (over_a, over_b) = cut[0], cut[1], map(ranges, cut[2:])
        links, k = [], 0
        for x, (s, e) in zip(ids_a, over_a):
            while over_b[k][1] <= s:
                k += 1
            j = k
            while j < len(over_b) and over_b[j][0] < e:
                links.append((x, ids_b[j]))
                j += 1
        groups, ka, kb = [], 0, 0
        for end in sorted({e for _, e in over_a} & {e for _, e in over_b}):
            ja, jb = ka, kb
            while ja < len(over_a) and over_a[ja][1] <= end:
                ja += 1
            while jb < len(over_b) and over_b[jb][1] <= end:
                jb += 1
            groups.append(",".join(map(str, ids_a[ka:ja])) + "|" + ",".join(map(str, ids_b[kb:jb])))
            ka, kb = ja, jb
        found.append((i, (len(ids_a), len(ids_b), len(groups), links, ";".join(groups))))
        counts.update(set(links))
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for i, d in found:
        if d is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            links = d[3]
            out.append((i, *d[:3], len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(d[4].encode()).hexdigest()))
    return sorted(out, key=str)


ANY = ["a", "b", "é", " ", "  ", "\n", "\n\n", "\t", "▁", "ß", "中", "😀", " ", "\x00", "'s", "12", "the", "<|endoftext|>", "<s>", "foo", "\r\n", "　", ".", "\x1c", "Eau"]
USUAL = [x for x in ANY if x not in ("\t", "▁", " ", "\r\n", "　", "\x1c")]


def odd_documents():
    pick = random.Random(5)
    made = [(i, "".join(pick.choice(kind) for _ in range(pick.randint(0, 40)))) for kind in (ANY, USUAL) for i in range(700)]
    return [*made, (None, None), (None, "a b"), (5, "a b"), (5, "a b"), (6, " "), (7, "\n"), (8, "the " * 4000 + "中" * 500), (9, "x" * 3000)]


@pytest.mark.parametrize("lookup", [token_alignment.LOOKUP, 1])
def test_odd_texts_equal_brute_force(spark, tokens, lookup):
    documents = odd_documents()
    df = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(4)
    assert rows(token_alignment.align(df, lookup)) == brute_force(documents, tokens)


def test_supplied_documents_equal_brute_force(spark, small, tokens):
    df = table(spark, small, "documents")
    got = token_alignment.op13(df)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(got) == brute_force([(r["doc_id"], r["text"]) for r in df.collect()], tokens)


def test_groups_are_the_text_that_is_digested(spark, tokens):
    documents = odd_documents()[-60:]
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(documents)], "doc_id bigint, text string")
    groups = {r["doc_id"]: r["groups"] for r in token_alignment.groups(df).collect()}
    for r in token_alignment.align(df).collect():
        g = groups[r["doc_id"]]
        assert r["groups_sha256"] == ("" if g is None else hashlib.sha256(g.encode()).hexdigest())


def test_pointers_end_in_the_last_token_of_a_component():
    pick = np.random.default_rng(2)
    for n in (1, 5, 400):
        ends = [np.unique(np.r_[pick.integers(1, 2 * n + 1, n), 2 * n]) for _ in range(2)]
        label_a, label_b, link_a, link_b = token_alignment.terminal_tokens(*ends)
        both = np.intersect1d(*ends)
        assert len(np.unique(label_a)) == len(both) and (ends[0][np.unique(label_a)] == both).all()
        for label, end in ((label_a, ends[0]), (label_b, ends[1])):
            assert (ends[0][label] == both[np.searchsorted(both, end)]).all()
        assert len(link_a) == len(link_b) == len(ends[0]) + len(ends[1]) - len(both)


def test_no_rows_and_clashing_columns(spark):
    assert token_alignment.op13(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    df = spark.createDataFrame([(1, "a b", 3, "x", 4)], "doc_id bigint, text string, n_a int, pair string, h1 int")
    assert token_alignment.align(df, 1).first()["n_a"] == 2
    assert rows(token_alignment.align(df)) == rows(token_alignment.align(df, 0))


def test_forgotten_pieces_change_nothing(spark, tokens, monkeypatch):
    documents = odd_documents()[:200]
    small = token_alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    small.LIMIT = 3
    once = [list(small.block([t]).texts()) for _, t in documents]
    assert once == [list(small.block([t]).texts()) for _, t in documents]
    whole = token_alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    whole.cut = False  # whole texts
    assert once == [list(whole.block([t]).texts()) for _, t in documents]
