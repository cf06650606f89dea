"""Ids and decoded texts equal the library's on whole tables, broken texts and any ids."""

import random
from hashlib import sha256

import pytest

from conftest import SF_SMALL
from trip_engine.llm import sentencepieces as sp


@pytest.fixture(scope="module")
def pieces():
    return sp.PieceModel(sp.MODEL)


def test_nasty_texts(pieces):
    rnd = random.Random(1)
    parts = ["a", "b", " ", "  ", "   ", "\n", "\t", "é", "ß", "汉", "ﬁ", "\xa0", "1", "<s>", "<0x41>", "▁", "\0", "\x1c",
             "A", "ǅ", "\U0001f600", "퟿", "the", " th", "ing", "�", "</s>", "<unk>", "\U0010ffff", ",", ".", "'s", "-",
             "_", "^", "]", "[", "\\", "!!", "::", "()", "=", "http://", "́"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 18))) for _ in range(30_000)]
    texts += ["a" * 5000, " " * 999, "ab " * 900, "▁" * 77, "\n" * 50, "x" * 40_000 + " " + "yz" * 20_000, ""]
    ids = pieces.encode(texts)
    decoded = [pieces.decode(x) for x in ids]
    assert all(pieces.agrees(texts, ids, decoded))
    assert not any(pieces.agrees(["ab c"] * 2, [[1], pieces.encode(["ab c"])[0]], ["ab c", "abc"]))


def test_a_wrong_part_is_found_in_its_batch():
    """A model with a spoilt score: the check finds just the texts that it spoils."""
    spoilt = sp.PieceModel(sp.MODEL)
    texts = ["the cat and a hat", "nothing of it here: 12 é", "", "for the other\nthe end", "x" * 300]
    ids = spoilt.encode(texts)
    assert spoilt.check(texts, ids, [*map(spoilt.decode, ids)]) == [True] * 5
    del spoilt.rank["▁the"], spoilt.rank["the"]
    spoilt.known, spoilt.older = {}, {}
    ids = spoilt.encode(texts)
    assert spoilt.check(texts, ids, [*map(spoilt.decode, ids)]) == [False, True, True, False, True]
    assert spoilt.check(texts[:2], ids[:2], [*map(spoilt.decode, ids[:2])]) == [False, True]  # known as wrong now


def test_parts_behind_a_line_end(pieces):
    """What the check of parts rests on: the parts' ids side by side are the text's."""
    rnd = random.Random(9)
    for _ in range(3000):
        text = "".join(rnd.choice(["a", "the", " ", "  ", "\n", ".", ",", "'s", "é", "ñ", "1", "_", "▁", "x-y"])
                       for _ in range(rnd.randint(1, 14)))
        alone = [pieces.library.encode("\n" + p.replace(sp.MARK, " ")) for p in pieces.parts(text)]
        assert all(x[:len(pieces.lead)] == pieces.lead for x in alone)
        assert [i for x in alone for i in x[len(pieces.lead):]] == pieces.library.encode(text)


def test_any_ids_decode(pieces):
    rnd = random.Random(2)
    for _ in range(30_000):
        ids = [rnd.choice([rnd.randrange(263), rnd.randrange(3, 259), rnd.randrange(32_000), 28705, 259, 2])
               for _ in range(rnd.randint(0, 8))]
        assert pieces.decode(ids) == pieces.library.decode(ids), ids


def test_one_pair_at_a_time(pieces):
    """The agenda does what the plain loop over all pairs does."""
    def plain(text):
        symbols = list(text)
        while True:
            found = [(pieces.rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in pieces.rank]
            if not found:
                return symbols
            _, i = min(found)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]

    rnd = random.Random(3)
    for _ in range(1500):
        text = "".join(rnd.choice(["▁", "a", "b", "e", "n", "t", "i", "é", "1"]) for _ in range(rnd.randint(0, 40)))
        assert pieces.merge(text) == plain(text)


def test_a_small_cache_changes_nothing(monkeypatch):
    texts = ["some words, some more words; and words again " * 20, "x y z " * 50]
    want = sp.PieceModel(sp.MODEL).encode(texts)
    monkeypatch.setattr(sp, "CACHE", 3)
    assert sp.PieceModel(sp.MODEL).encode(texts) == want


def test_query_over_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    library = sp.PieceModel.of(sp.MODEL).library
    want = {}
    for r in docs.collect():
        ids = library.encode(r["text"] or "")
        want[r["doc_id"]] = (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             sha256(library.decode(ids).encode()).hexdigest(), True)
    rows = sp.op11_sentencepiece(docs).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["agrees"]) for r in rows} == want
    whole = sp.encode_documents(docs, check=False).first()
    assert whole["agrees"] is None and whole["decoded"] == library.decode(whole["ids"])


def test_other_models_are_refused(monkeypatch, tmp_path):
    import public_tokenizers
    with open(public_tokenizers.path(sp.MODEL), "rb") as f:
        data = f.read()
    at = data.rindex(b"identity")
    other = data[:at - 4] + bytes([data[at - 3]]) + data[at - 3:]  # a broken file is no model either
    (tmp_path / "m").write_bytes(other)
    monkeypatch.setattr(public_tokenizers, "path", lambda name: str(tmp_path / "m"))
    with pytest.raises(Exception):
        sp.PieceModel("m")
