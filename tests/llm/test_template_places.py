"""Templates against a brute force over tuples of tokens, and a benchmark item at several places of one document."""

import random

import pytest

from stratamart.llm import templates

QUESTION = "Maria buys 12 apples at $3 each and then sells 5 of them to Carlos for $4 each. How much money does she have left?"
EQUAL = "Maria buys 31 apples at $31 each and then sells 31 of them to Maria for $31 each. How much money does she have left?"


def test_a_copy_counts_beside_an_inconsistent_filling_of_its_template(spark):
    docs = spark.createDataFrame([(1, f"{QUESTION} {EQUAL}"), (2, f"{EQUAL} {QUESTION}"), (3, EQUAL)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, QUESTION)], "item_id bigint, text string")
    assert {(r["doc_id"], r["reworded"]) for r in templates.op2(docs, items).collect()} == {(1, False), (2, False)}
    assert [r["doc_id"] for r in templates.clean(docs, items).collect()] == [3]


def leaked(spark, docs, items):
    found = templates.op2(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    return {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_items_dense_in_slots_and_short_items_are_found_verbatim(spark):
    items = [(1, "12 + 15 = 27 and 30 / 5 = 6 then 9 * 9 = 81"), (2, "forty-two"), (3, "Who wrote Faust?"), (4, "3 km 5 kg Paris Rome 7 h 9 min Ada Lovelace 11 m"), (5, "...")]
    docs = [(10 + i, f"We are told that {t} is what they ask. And so on.") for i, t in items] + [(20, "We add 12 and 15 to have 28."), (21, "He wrote Faust, who knows"), (22, "Paris 3 Rome 4")]
    assert leaked(spark, docs, items) == {(11, 1), (12, 2), (13, 3), (14, 4)}


def test_values_of_other_lengths_and_a_word_more_do_not_hide_a_question(spark):
    item = "Carlos has 25 marbles and gives 10 of them to Anna before he sells the rest of his marbles for 40 dollars at the market in Berlin today."
    docs = [
        (1, "Juan Carlos has twenty five marbles and gives 7 of them to Mary Ann before he sells the rest of his marbles for $ 60 at the market in New York today."),
        (2, item.replace("sells the rest", "quickly sells the whole rest").replace("25", "31").replace("Anna", "Eva")),
        (3, "Carlos likes the market in Berlin, where Anna sells marbles for 40 dollars."),
    ]
    assert leaked(spark, docs, [(9, item)]) == {(1, 9), (2, 9)}


# ---- brute force: windows are tuples, matches are found by comparing all with all
def plain_tokens(text):
    """(type, template, value) of the collapsed tokens, word by word."""
    out, begins = [], True
    for line in (text or "").split("\n"):
        begins = True
        for word in line.split():
            for kind, value in templates.tokens(word):
                kind = 0 if kind == 3 and begins else kind
                sort = {1: "number", 2: "number", 3: "name"}.get(kind)
                if sort and out and out[-1][0] == sort and not begins:
                    out[-1][1].append((kind, value))
                else:
                    out.append((sort, [(kind, value)]))
                begins = False
            begins = word[-1] in ".!?:;"
    made = []
    for sort, parts in out:
        kind = 1 if any(k == 1 for k, _ in parts) else parts[0][0]
        made.append((kind, f"<{kind}>" if kind else parts[0][1], tuple(v for _, v in parts)))
    return made


def brute_windows(text, length):
    t = plain_tokens(text)
    for at in range(len(t) - length + 1):
        w = t[at : at + length]
        if 2 * sum(k == 0 for k, _, _ in w) >= length >= templates.MIN_ITEM:
            yield at, ("t", *(x for _, x, _ in w)), [v for k, _, v in w if k]
        else:
            yield at, ("l", *(v for _, _, v in w)), []


def brute_force(docs, items):
    out = set()
    for item, text in items:
        size = min(templates.WINDOW, len(plain_tokens(text)))
        own = list(brute_windows(text, size)) if size else []
        for doc, words in docs:
            met = [(at - i_at, i_at, i_slots, slots) for at, key, slots in brute_windows(words, size) for i_at, i_key, i_slots in own if key == i_key] if own else []
            shifts = {s for s, *_ in met}
            low = {s // templates.NEAR * templates.NEAR for s in shifts}
            groups = [[m for m in met if m[0] == s] for s in shifts] + [[m for m in met if b <= m[0] < b + 2 * templates.NEAR] for b in low | {x - templates.NEAR for x in low}]
            for g in groups:
                matched = len({i_at for _, i_at, _, _ in g})
                if matched and (matched / len(own) >= templates.MIN_SHARE or matched + size - 1 >= templates.MIN_TOKENS):
                    pairs = {p for _, _, a, b in g for p in zip(a, b)}
                    if not pairs or min(len({a for a, _ in pairs}), len({b for _, b in pairs})) / len(pairs) >= templates.MIN_CONSISTENT:
                        out.add((doc, item))
    return out


def questions(seed):
    """Questions over few words, so that windows meet by chance as well, with numbers, names and units; copies, fillings, cuts."""
    pick = random.Random(seed)
    words = "the a of buys sells apples road train has runs left how many then".split()
    slots = ["12", "7", "$3", "40 dollars", "twenty five", "5 km", "3 kg", "Ada", "Maria Luz", "Bo", "2/3", "sixty-one"]
    line = lambda n: " ".join(pick.choice(slots) if pick.random() < 0.3 else pick.choice(words) for _ in range(n))
    items = [(i, line(pick.choice([1, 3, 5, 8, 15, 25])) + pick.choice(["", ".", "?"])) for i in range(25)]
    docs = []
    for d in range(60):
        _, text = pick.choice(items)
        parts = text.split(" ")
        if d % 3 == 1:
            parts = [pick.choice(slots) if p in slots and pick.random() < 0.7 else p for p in parts]
        elif d % 3 == 2:
            parts.insert(pick.randrange(len(parts) + 1), pick.choice(words))
        docs.append((d, f"{line(pick.randint(0, 20))}. {' '.join(parts)} {line(pick.randint(0, 20))}"))
    return [*docs, (98, None), (99, "")], [*items, (98, None), (99, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_leaks_equal_brute_force(spark, seed):
    docs, items = questions(seed)
    want = brute_force(docs, [i for i in items if i[1]])
    assert leaked(spark, docs, items) == want and len(want) > 20


def test_a_long_text_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "word " * 40_000 + QUESTION + " more" * 40_000, 3, "x")], "doc_id bigint, text string, shift int, hash string")
    items = spark.createDataFrame([(7, QUESTION, "a")], "item_id bigint, text string, slots string")
    assert [(r["item_id"], r["matched"] > 10) for r in templates.op2(docs, items).collect()] == [(7, True)]
    assert templates.clean(docs, items).columns == docs.columns
