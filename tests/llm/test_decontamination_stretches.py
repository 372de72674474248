"""Stretches of a benchmark item: their ends, and slots that do not fit far from them."""

from rolecast.llm import decontaminate
from rolecast.llm.decontaminate import Canon, Index

ITEM = "the quick brown fox jumps over some fences 3 km 4 kg 5 then seven other little words follow here"
TAIL = "the quick brown fox jumps over some fences 7 km 8 kg 9"
FAR = "if Anna walks 12 km and then meets Bob near the old station while Carl sleeps in the garden alpha beta gamma delta epsilon zeta eta theta iota kappa lambda 12 eggs remain"


def found(item, *texts):
    return Index([(1, item)]).search(Canon(), list(texts))


def test_item_cut_off_at_the_end_counts_the_same_alone_and_in_a_batch():
    assert found(ITEM, TAIL) == {0: {1: 13}}
    assert found(ITEM, TAIL, "another text that lies behind it in the run of words and is long enough to reach on") == {0: {1: 13}}
    assert found(ITEM, "before it", TAIL, TAIL) == {1: {1: 13}, 2: {1: 13}}


def test_item_cut_off_at_the_start_counts_the_same_alone_and_in_a_batch():
    item, head = "well then seven other words come 5 km 4 kg 3 fences over jumps fox brown quick the end", "9 km 8 kg 7 fences over jumps fox brown quick the end"
    alone = found(item, head)
    assert alone == {0: {1: 13}}
    assert found(item, "a text that lies in front of it and has enough words", head) == {1: alone[0]}


def test_words_of_the_next_document_do_not_count():
    first, second = "the quick brown fox jumps over some fences 7 km 8 kg", "9 then seven"
    assert not found(ITEM, first, second)


def test_a_number_far_from_a_stretch_does_not_discard_it():
    text = "if Maria walks 15 km and then meets Tom near the old station while Paul sleeps in the garden " + " ".join(f"q{chr(97 + i)}x" for i in range(11)) + " 99 eggs and more"
    assert found(FAR, text)[0][1] >= 13


def test_stretches_that_contradict_each_other_are_not_added_up():
    item = "old boats carry Anna along the wide river aa bb cc dd ee ff gg hh ii jj and there hears Anna sing of the sea"
    text = "old boats carry Maria along the wide river ka kb kc kd ke kf kg kh ki kj and there hears Zoe sing of the sea"
    same = text.replace("Zoe", "Maria")
    assert 0 in found(item, same) and not found(item, text)


def test_many_blocks_find_what_one_does(spark):
    items = [(i, f"Question number {i}: if Anna has {i + 3} red apples and gives away two of them, how many apples of the {['old', 'new', 'tall'][i % 3]} tree are left?") for i in range(12)]
    docs = [(i, f"some words before. {items[i % 12][1]} and after") for i in range(20)] + [(50, None), (51, "nothing of the kind"), (50, items[0][1]), (52, items[0][1] + " " + items[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (99, None), (None, "x")], "item_id long, text string")
    one = decontaminate.contamination(df, bench)
    for size in (1, 300):
        many = decontaminate.contamination(df, bench, block_bytes=size)
        assert many.columns == one.columns and sorted(map(str, many.collect())) == sorted(map(str, one.collect()))
    assert one.filter("size(item_ids) > 0").count() == 22
