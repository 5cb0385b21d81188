"""Words to ids as the library's plain call gives them; words of Latin letters and closing marks by the model alone."""

import json
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from sensorstream.llm import token_files
from sensorstream.llm.catalog import tokenizer_file


@pytest.fixture(scope="module")
def path():
    return tokenizer_file("word_bpe_49k.json")


def _ids(words, text):
    return np.frombuffer(words.encode([text], 2)[0], "<u4").tolist()


def test_any_text_as_the_library_does(path):
    words, rnd = token_files._Words(path), random.Random(1)
    letters = "abzABZéÉßÿþÐ×÷ñ'.,!%&_-`~ \n\t019µªº́̀İıſKÅ中\x01\xa0\xad<|>"
    for k in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(25))) + ("<|endoftext|>" if k % 20 == 0 else "")
        assert _ids(words, text) == [*words.tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_latin_words_need_no_normaliser_or_splitter(path, monkeypatch):
    words = token_files._Words(path)
    text = "The Élan,,, zéro-\nnaïve... thing's 'so it''' %%%"
    wanted = [*words.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    asked, plain = [], words._ids
    monkeypatch.setattr(words, "_ids", lambda w: asked.append(w) or plain(w))
    assert _ids(words, text) == wanted and sorted(asked) == ["'so", "thing's"]


def test_caches_are_emptied_and_filled_again(path, monkeypatch):
    monkeypatch.setattr(token_files, "MOST_WORDS", 3)
    monkeypatch.setattr(token_files, "MOST_PIECES", 3)
    words = token_files._Words(path)
    texts = ["one two three four five.", "six, one", "two three!", ""] * 2
    got = [np.frombuffer(x, "<u4").tolist() for t in texts for x in words.encode([t], 2)]
    assert got == [[*words.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert len(words.pieces) <= 3


def test_ids_of_any_width_are_counted(monkeypatch):
    monkeypatch.setattr(token_files, "COUNT_IDS", 3)
    docs = [np.array(x, "<u4") for x in ([1, 2, 2], [70_000, 1], [65_535], [65_536])]
    raw = [token_files._narrow(x) for x in docs]
    assert [len(x) for x in raw] == [6, 8, 2, 4]
    batch = pa.RecordBatch.from_arrays([pa.array([len(x) for x in docs]), pa.array(raw, pa.binary())], names=["n", "ids"])
    rows = pa.Table.from_batches(token_files._count(iter([batch]))).to_pydict()
    assert dict(zip(rows["token"], rows["times"], strict=True)) == {1: 2, 2: 2, 65_535: 1, 65_536: 1, 70_000: 1}
    assert pa.Table.from_batches(token_files._count(iter([]))).num_rows == 0


def test_each_piece_of_a_slice_is_looked_up_once(path):
    class Asked(dict):
        def get(self, *key):
            asked.append(key[0])
            return super().get(*key)

    words, asked = token_files._Words(path), []
    words.pieces = Asked(words.pieces)
    texts = ["Élan, one; one, élan", "one ONE one. ", "one,\nÉLAN."] * 50
    got = words.encode(texts, 2)
    wanted = [[*words.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == wanted
    assert sorted(asked) == ["", ",", ".", ";", "one", "Élan", "élan"]  # only A-Z is lowered before


@pytest.mark.parametrize("change", ["none", "added", "splitter"])
def test_many_texts_at_once_as_the_library_does(path, tmp_path, change):
    rules = json.loads(Path(path).read_text())
    if change == "added":  # strings of letters and of marks, also inside words
        rules["added_tokens"] += [{**rules["added_tokens"][0], "id": 49408 + k, "content": x} for k, x in enumerate(["on", "!?", "Ab"])]
    if change == "splitter":  # each mark alone: the model alone won't do
        rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    words, rnd = token_files._Words(str(tmp_path / "rules.json")), random.Random(2)
    assert words.simple == (change != "splitter")
    some = ["one", "One,", "on", "ab", "Ab", "aB!?", "!?", "...", "naïve;", "ÉTÉ", "it's", "'tis", "a1b2", "中文", "x<|endoftext|>y", "<|ENDOFTEXT|>", "", "\t", "<", "Ð"]
    for _ in range(40):
        texts = ["".join(rnd.choice(some[: rnd.choice([9, 14, 20])]) + rnd.choice(" \n") for _ in range(rnd.randrange(8))) for _ in range(6)]
        wanted = [[*words.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        for given in (texts, pa.array(["before", *texts, "after"]).slice(1, 6)):
            assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(given, 2)] == wanted, texts
