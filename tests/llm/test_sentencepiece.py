"""SentencePiece encoding against the library, and edge rows."""

import random

import pytest
import sentencepiece

from titleflow.llm import spm
from titleflow.llm.queries import PIECE_FILE

from .conftest import EDGE


@pytest.fixture(scope="module")
def model():
    return spm.load(PIECE_FILE)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)


def texts():
    draw = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "1", "é", "日", "😀", "<s>", "|", "\x1c", "\x85", "\xa0", "the", " the", "▁", "\x00", "<0x0A>", "�"]
    out = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    out += ["".join(draw.choice("abcdethin ") for _ in range(400)) for _ in range(100)]
    out += ["".join(draw.choice("▁ a") for _ in range(draw.randint(0, 60))) for _ in range(200)]
    return out + ["a" * 5000, " " * 5000, "日本" * 2000, "".join(draw.choice("abcdethins") for _ in range(20000))]


def test_encoding_and_decoding_equal_the_library(model, library):
    encode = spm.Encoder(model).encode
    for t in texts():
        ids = library.encode(t)
        assert encode(t) == ids
        assert spm.decode(ids, model) == library.decode(ids)


def test_random_pieces_equal_the_library(model, library):
    draw, encode, pieces = random.Random(2), spm.Encoder(model).encode, list(model.ids)
    for _ in range(2000):
        t = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 10)))
        assert encode(t) == library.encode(t)
        ids = [draw.randrange(len(model.pieces)) for _ in range(draw.randint(0, 6))]
        ids += [draw.randrange(3, 259) for _ in range(draw.randint(0, 6))]
        assert spm.decode(ids, model) == library.decode(ids)


def test_backtracking_takes_pieces_back(model):
    """A longest match that can't be followed is given up for a shorter one."""
    encoder = spm.Encoder(model)
    draw = random.Random(3)
    back = 0
    for _ in range(300):
        t = "".join(draw.choice("abcdethins") for _ in range(60))
        greedy, at, longest = [], 0, encoder.longest(t)
        while at < len(t):
            greedy.append(longest[at])
            at += encoder.size[longest[at]]
        ids = encoder.cut(t)
        back += ids != greedy
        assert "".join(model.pieces[i] for i in ids) == t and [model.pieces[i] for i in ids] == spm.merged(t, model.rank)
    assert back > 50


def test_cuts_do_not_change_the_ids(model):
    whole, cut = spm.Encoder(model), spm.Encoder(model)
    for t in texts()[:500]:
        if t:
            assert cut.encode(t) == whole.cut("▁" + t.replace(" ", "▁"))


def test_models_that_rewrite_text_are_refused(tmp_path):
    data = open(PIECE_FILE, "rb").read()
    # The normaliser's spec with "remove extra white space" switched on.
    assert data.count(b"\n\x08identity\x12\x00\x18\x01 \x00") == 1
    changed = tmp_path / "changed.model"
    changed.write_bytes(data.replace(b"\n\x08identity\x12\x00\x18\x01 \x00", b"\n\x08identity\x12\x00\x18\x01 \x01"))
    with pytest.raises(ValueError):
        spm.load(str(changed))


def test_edge_rows(edge, none, library):
    rows = spm.encode_decode(edge, PIECE_FILE, ["doc_id", "score", "key"]).collect()
    assert sorted(map(list, (r["ids"] for r in rows))) == sorted(library.encode(t or "") for _, t, *_ in EDGE)
    assert sorted(r["decoded"] for r in rows) == sorted(t or "" for _, t, *_ in EDGE)
    assert {(r["score"], r["key"]) for r in rows} == {("x", "y")}
    assert spm.encode_decode(none, PIECE_FILE, ["doc_id"]).count() == 0
