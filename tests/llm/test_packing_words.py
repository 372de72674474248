"""The encoder of packing: how often it asks the library, and odd texts against the library."""

import random

import pytest

from rolecast.llm import packing, queries


class Counted:
    def __init__(self, model):
        self.model, self.asked = model, []

    def tokenize(self, word):
        self.asked.append(word)
        return self.model.tokenize(word)


@pytest.fixture
def encoder(spark):
    e = packing.Encoder(queries.tokenizer_path(spark))
    e.model = Counted(e.model)
    return e


def made(n, salt):
    rng = random.Random(salt)
    return sorted({"".join(rng.choices("abcdefghij", k=12)) for _ in range(n)})


def test_words_beyond_the_cache_are_encoded_once_a_text(encoder):
    encoder.MOST = 20
    words = made(200, 1)
    text = " ".join(words * 3)
    assert encoder(text) == encoder.whole(text)
    assert sorted(encoder.model.asked) == words


def test_frequent_words_stay_known_when_the_cache_is_full(encoder):
    encoder.MOST = 20
    for salt in range(30):
        encoder(" ".join(["frequent", *made(9, salt)]))
    assert encoder.model.asked.count("frequent") == 1


def test_batches_of_odd_texts_equal_the_library(encoder):
    rng = random.Random(3)
    signs = "aAbzéÉßÿ×÷µªº '’!<|>_-.0١٣日🎉İıſΣςKÅǅǆ\x00\x1c\x1f\x7f\x85\xa0\n\t\r\x0b\x0ć　 ​﻿"
    texts = [None, "", " ", "\n\t", "a<|endoftext|>b<|", "<|endoftext|>,x abc<| |> <|startoftext|>!", "abc\n", "abc\x00", "abc!́", "abc'"]
    texts += ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(2000)]
    want = [encoder.whole(t) if t else b"" for t in texts]
    assert encoder.batch(texts) == want
    assert encoder.batch(texts[:4]) == [b""] * 4 and encoder.batch([]) == []
