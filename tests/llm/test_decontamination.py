"""Decontamination: planted passages, changed values, odd rows."""

import re

import pytest

from innledger.llm import decontamination
from innledger.llm.queries import QUERIES

DOCS = "doc_id long, text string, item_id string, leaks int, __leaks int"
ITEM = (
    "A train leaves Boston at 9 in the morning and travels 60 miles to meet Alice, "
    "who waits 2 hours. How fast must the train go if Alice leaves after 60 minutes?"
)


def found(spark, texts, items=((1, ITEM),)):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], DOCS)
    benchmark = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontamination.leaked_pairs(docs, benchmark).collect()}


def test_passages_of_the_whole_table(spark):
    """Exactly the documents that hold an item as it is, upper-case and spaces aside."""
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op7_benchmark_decontamination"](spark, sf).collect()
    words = lambda text: " " + " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split()) + " "
    items = [(r.item_id, words(r.text)[1:-1]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r.doc_id, words(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(d, i) for d, text in docs for i, item in items if f" {item.split(' ', 1)[1]}" in text}
    got = {(r.doc_id, r.item_id) for r in rows}
    assert len(got) == len(rows) and want <= got
    for d, i in got - want:  # a few words may be changed
        assert len(set(dict(docs)[d].split()) & set(dict(items)[i].split())) >= 0.8 * len(
            set(dict(items)[i].split())
        )


def test_copies_with_other_values(spark):
    other = ITEM.replace("Alice", "Maria").replace("60", "75").replace("Boston", "Denver")
    mixed_up = ITEM.replace("waits 2 hours. How fast must the train go if Alice", "waits 2 hours. How fast must the train go if Maria").replace("60 minutes", "7 minutes").replace("9 in", "4 in")
    before = "Some words stand here first. "
    texts = [
        before + ITEM + " And more follows.", before + other, ITEM.upper(), ITEM[: len(ITEM) // 2],
        "A train leaves town and nobody waits.", ITEM.replace("morning", "evening"), mixed_up, "",
    ]
    got = found(spark, texts)
    assert {d for d, _ in got} >= {0, 1, 5} and not {d for d, _ in got} & {3, 4, 7}
    assert got[0, 1].renamed == 0 and got[0, 1].slots >= 7
    assert got[1, 1].renamed == 5
    assert 6 not in {d for d, _ in got}  # one name stands for two, one number for two


def test_odd_rows(spark):
    texts = [None, "", "5 5 5 5 5 5 5 5 5", (ITEM + " ") * 3000, "word " * 100_000]
    items = [(1, ITEM), (1, ITEM), (None, ITEM), (2, None), (3, ""), (4, "too short"), (5, "7 8 9 10 11 12 13")]
    got = found(spark, texts, items)
    assert {d for d, _ in got} == {3} and {i for _, i in got} == {1, None}
    docs = spark.createDataFrame([(None, ITEM, "a", 1, 2), (None, ITEM, "a", 1, 2), (1, None, None, None, None)], DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    clean = decontamination.without_leaks(docs, benchmark)
    assert clean.columns == docs.columns
    assert [tuple(r) for r in clean.collect()] == [(1, None, None, None, None)]
    assert decontamination.leaked_pairs(docs, benchmark.limit(0)).collect() == []
    assert decontamination.leaked_pairs(docs.limit(0), benchmark).collect() == []


@pytest.mark.parametrize("size", [200, 1 << 20])
def test_blocks_of_the_benchmark(spark, monkeypatch, size):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", size)
    items = [(k, f"the {w} crossed an old bridge and then it slept under some tall trees") for k, w in enumerate(["fox", "dog", "cat", "hen", "cow", "owl"])]
    texts = [t for _, t in items] + ["nothing at all is in this one text here"]
    got = found(spark, texts, items)
    assert {d for d, _ in got} == set(range(6)) and all((k, k) in got for k in range(6))
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate([*texts, None])], DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    clean = decontamination.without_leaks(docs, benchmark)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [6, 7]


def test_values_are_replaced_one_to_one(spark):
    item = (
        "On a sunny day Tom gives 5 red apples to Anna and then buys 7 green pears at the market, "
        "while the others carry 9 large boxes home and put 11 small jars on the shelf."
    )
    change = lambda new: "".join(new.get(x, x) for x in re.split(r"(\w+)", item))
    texts = [
        change({"Tom": "Bob", "Anna": "Bob", "5": "3", "7": "3", "9": "3", "11": "3"}),
        change({"Tom": "Bob", "Anna": "Eve", "5": "3", "7": "4", "9": "6", "11": "8"}),
        change({"Tom": "Anna", "Anna": "Tom", "5": "7", "7": "5"}),
        change({"Anna": "Tom"}), item,
    ]
    got = found(spark, texts, [(1, item)])
    assert {d for d, _ in got} == {1, 2, 3, 4}
    assert [got[d, 1].renamed for d in (1, 2, 3, 4)] == [6, 4, 1, 0]


def test_names_that_begin_sentences(spark):
    item = "Tom has 5 apples. Tom buys 3 more pears. How many fruits does Tom have now?"
    other = item.replace("Tom", "Anna").replace("5", "8").replace("3", "6")
    two = other.replace("Anna buys", "Peter buys")
    got = found(spark, [other, "Read this first. " + item, two], [(1, item)])
    assert {d for d, _ in got} == {0, 1}
    assert got[0, 1].slots == got[0, 1].renamed == 5 and got[1, 1].renamed == 0


def test_short_items_inside_a_sentence(spark):
    item = "Which planet has the shortest day?"
    texts = [f'The teacher waited and then asked, "{item}" Nobody knew.', "it says: " + item.lower(), "Which planet is it?"]
    assert {d for d, _ in found(spark, texts, [(1, item)])} == {0, 1}


def test_copies_behind_others_of_the_template(spark):
    item = "Alice has 12 red marbles and gives 12 to Bob, then Bob gives Alice 7 of the marbles back."
    drill = "Cara has 1 red marbles and gives 2 to Dora, then Emma gives Frank 3 of the marbles back."
    edited = item.replace("the marbles", "the blue marbles")
    table = " ".join(["and gives 4 to Gina, then Hans gives Ida 5 of the marbles back"] * 20)
    apart = "Other things are told here which have nothing to do with it. " * 4
    texts = [f"{drill} {apart}{item}", f"{drill} {apart}{edited} {drill}", f"{table}. {item} {table}.", drill, f"{drill} {drill} {table}."]
    assert {d for d, _ in found(spark, texts, [(1, item)])} == {0, 1, 2}


def test_items_of_hardly_any_words(spark):
    sums = "Compute 12 + 7 * 30 - 4 / 2 = 9"
    digits = "Add the numbers 3 7 1 8 2 5 9 4 6"
    short = "Who wrote Hamlet?"
    texts = [
        f"The board said: {sums}. Then all went home.", "Compute 11 + 6 * 29 - 3 / 1 = 8",
        f"First, {digits}.", "add the numbers 4 4 4 and then stop", digits.replace("7 1", "4 6"),
        'She asked, "who wrote Hamlet?" and left.', "Who wrote Macbeth?",
    ]
    got = found(spark, texts, [(1, sums), (2, digits), (3, short)])
    assert set(got) == {(0, 1), (2, 2), (4, 2), (5, 3)}
    assert got[0, 1].matched == got[0, 1].windows == 3 and got[2, 2].windows == 8


def test_a_column_of_the_same_name_is_replaced(spark):
    words = "which planet of all has by far the shortest day of them"
    docs = spark.createDataFrame([(1, f"so: {words}", "old"), (2, "none", "old")], "doc_id long, text string, leaks string")
    items = spark.createDataFrame([(7, words)], "item_id long, text string")
    got = decontamination.with_leaks(docs, items).collect()
    assert {r.doc_id: [x.item_id for x in r.leaks] for r in got} == {1: [7], 2: []}
