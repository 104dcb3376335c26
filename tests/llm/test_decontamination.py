from __future__ import annotations

import random
import re

from tidemark.llm.decontamination import _TOKENS, LITERAL, NAMED, TEMPLATE, _bits, _Words, clean, contaminated, forms, slots_of, windows
from tidemark.llm.queries import QUERIES

DOCS = "doc_id long, text string, item_id string, hash int"
ITEMS = "item_id long, text string, values int"


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS)
    b = spark.createDataFrame([(*r, 1) for r in items], ITEMS)
    return {(r.doc_id, r.item_id): (r.covered, r.windows, r.exact) for r in contaminated(d, b, **kw).collect()}


Q = "If Anna buys 12 apples for 3 dollars and then gives Anna's brother 4 of the apples, how many does Anna have left?"


def made(text, known=None):
    """The forms of one text, without the word that ends it."""
    return [type(f)(f.values[:-1], f.slots[:-1], f.places[:-1]) for f in forms((known or _Words(None)).codes([_TOKENS.findall(text)]))]


def slots(text, kind):
    """Values of a form's placeholders, and the form without them."""
    form = made(text)[kind]
    words = [t for t in _TOKENS.findall(text) if t not in ".!?\n"]
    ends = [*form.places[1:].tolist(), len(words)]
    spans = [" ".join(words[a:b]) for a, b in zip(form.places.tolist(), ends)]
    return [x for x, s in zip(spans, form.slots) if s], form.values.tolist()


def test_placeholders():
    text = "Anna met Bob Ray. Then 3.5 kg and kg of 3/4 Apples\nCarl slept"
    assert slots(text, TEMPLATE)[0] == ["Bob Ray", "3.5", "kg", "3 4", "Apples"]
    assert slots(text, NAMED)[0] == ["Anna", "Bob Ray", "Then", "3.5", "kg", "3 4", "Apples", "Carl"]
    other = "Zoe met Carl! Now 9 miles and KG of 10 Green Pears\nAnna slept"
    assert slots(other, NAMED)[1] == slots(text, NAMED)[1] and slots(other, TEMPLATE)[1] != slots(text, TEMPLATE)[1]
    assert slots(text, LITERAL)[0] == [] and all(len(f.values) == 0 for f in made(""))


def test_other_words_end_windows():
    known = _Words(None).codes([["one", "two", "three", "four", "five"]])
    form = made("One two unheard three four five", _Words(_bits(slots_of(known))))[LITERAL]
    assert windows(form, 3)[0].tolist() == [3] and windows(form, 2)[0].tolist() == [0, 3, 4]


def test_texts_of_a_batch_do_not_meet():
    texts = [_TOKENS.findall(t) for t in ("one two three", "", "four. Five six", "seven eight nine ten")]
    for form in forms(_Words(None).codes(texts)):
        assert windows(form, 3)[0].tolist() == [0, 5, 9, 10] and len(windows(form, 5)[0]) == 0


def test_reparameterised_questions(spark):
    other = Q.replace("Anna", "Zoe").replace("12", "30").replace("3 dollars", "5 euros").replace(" 4 ", " 8 ")
    mixed = Q.replace("buys 12", "buys 30").replace("Anna have", "Zoe have").replace("12", "30")
    docs = [(1, f"some words. {Q} and more"), (2, f"intro text here\n{other}"), (3, mixed), (4, "nothing of the kind is in this text at all, it is clean"), (5, None), (6, ""), (None, Q)]
    got = run(spark, docs, [(7, Q), (8, "too short"), (9, None), (None, Q)])
    assert got[(1, 7)][2] and not got[(2, 7)][2] and got[(2, 7)][0] == got[(2, 7)][1]
    assert set(got) == {(1, 7), (2, 7)}


def test_short_items_copies_and_repeats(spark):
    short = "five little words are here"
    docs = [(1, f"x y {short} z"), (1, f"x y {short} z"), (2, "five little words were here"), (3, "a " * 120_000 + short)]
    got = run(spark, docs, [(1, short), (2, short)])
    assert set(got) == {(1, 1), (1, 2), (3, 1), (3, 2)}


def test_clean_keeps_the_rest(spark):
    d = spark.createDataFrame([(1, Q, "x", 1), (2, "other", "x", 1), (None, None, "x", 1), (2, "other", "x", 1)], DOCS)
    b = spark.createDataFrame([(7, Q, 1)], ITEMS)
    left = clean(d, b)
    assert left.columns == d.columns and sorted(map(str, left.collect())) == sorted(map(str, d.filter("doc_id is null or doc_id = 2").collect()))
    assert clean(d, b.limit(0)).count() == 4 and contaminated(d.limit(0), b).collect() == []


def test_query_against_plain_search(spark):
    """The items of the tables have no numbers or names, so whole passages must be found, and only those."""
    data = "/root/testdata/sf0.001"
    word = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = {r.item_id: " ".join(word(r.text)) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    docs = {r.doc_id: " " + " ".join(word(r.text)) + " " for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in t}
    got = QUERIES["op10_decontamination"](spark, data).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want and all(r.exact for r in got)


def test_verbatim_copies_of_any_item(spark):
    """Title case, capitals, lists of names or numbers and very short items leave no or few template windows."""
    items = ["How Many Apples Does Anna Have Left After Selling Ten", "WHAT IS THE NAME OF THE LONGEST RIVER ON EARTH", "Paris, London, Rome, Madrid, Berlin",
             "1, 2, 3, 5, 8, 13, 21, 34, 55", "Who wrote Hamlet?", "Five little words are here"]
    docs = [(k, f"As they said: {t} and more of it") for k, t in enumerate(items)] + [(9, "Paris, London, Rome, Berlin, Madrid"), (10, "1, 2, 3, 5, 9, 13, 21, 34, 55"), (11, items[0].lower())]
    got = run(spark, docs, list(enumerate(items)))
    assert set(got) == {(k, k) for k in range(len(items))} | {(11, 0)} and all(x[0] >= x[1] / 2 and x[2] for x in got.values())


def test_names_at_sentence_starts(spark):
    item = "Anna has 5 apples. Bob takes 3 of them away. How many apples are left now?"
    other = item.replace("Anna", "Zoe").replace("Bob", "Carl").replace("5", "9").replace("3", "4")
    swapped = item.replace("Bob", "Anna")  # two values of the item are one here
    got = run(spark, [(1, other), (2, swapped), (3, "Some apples. " + other.replace("apples", "pears"))], [(7, item)])
    assert set(got) == {(1, 7)} and got[(1, 7)][2] is False


def test_longer_values_in_the_middle(spark):
    words = "the baker put 12 rolls into a box and Anna carried it over the bridge to the market near the river"
    for old, new in (("12", "3/4"), ("Anna", "Mary Ann Lee"), ("12", "1 000 000")):
        assert set(run(spark, [(1, words.replace(old, new))], [(7, words)])) == {(1, 7)}
    added = words.replace("Anna", "then a very tired Anna")
    assert set(run(spark, [(1, added)], [(7, words)])) == {(1, 7)}


def test_periodic_copies(spark):
    item = "Anna met Bob and Carl met Dora and Emil met Fay and Gus met Hal and Ina met Joe and Kim met Leo"
    renamed = item.translate(str.maketrans("ABCDEFGHIJKL", "LKJIHGFEDCBA"))
    got = run(spark, [(1, item), (2, renamed)], [(7, item)])
    assert got[(1, 7)][2] and not got[(2, 7)][2]


def test_renamed_at_random_against_rule(spark):
    """Items with new values in every slot are found, those with an inconsistent or another text are not."""
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("ba", "do", "ke", "li", "mu", "so") for b in ("ran", "tel", "vik", "nos", "pim")]
    names, docs, items, want = ["Anna", "Bob", "Carl", "Dora", "Emil", "Fay"], [], [], set()
    for k in range(40):
        own = rng.sample(names, 3)
        words = [rng.choice(vocabulary) for _ in range(24)]
        for n, at in enumerate((3, 9, 15)):
            words[at] = own[n]
        words[19] = own[0]
        words[6] = str(rng.randrange(10, 99))
        items.append((k, " ".join(words)))
        fresh = dict(zip(own, rng.sample(["Gus", "Hal", "Ina", "Joe"], 3)))
        renamed = [fresh.get(w, w) for w in words]
        renamed[6] = str(rng.randrange(100, 999))
        kind = k % 4
        if kind == 1:
            renamed[19] = "Kim"  # the first name again, but another one
        if kind == 2:
            renamed = [w if i % 4 else "zzz" for i, w in enumerate(renamed)]
        docs.append((k, "and so on " + " ".join(renamed) + " to its end"))
        if kind in (0, 3):
            want.add((k, k))
    assert set(run(spark, docs, items)) == want
