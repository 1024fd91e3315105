"""Segments of the SentencePiece encoder: cut where no piece spans, so the ids are those of whole texts."""

import random

import public_tokenizers

from labelloom.llm.sentencepieces import Merger


def test_segments_cut_before_punctuation_have_the_librarys_ids():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        own = Merger(file.read())
    draw = random.Random(5)
    letters = "abcThe ,.;:!?()[]'\"-–0123456789\n\t\r▁éß漢字é😀\x00#$%&*/\\|<>^"
    for _ in range(5000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(40)))
        assert own.encode(text) == own.library.encode(text)
    assert own.cut.findall("▁word,▁(word).▁...word") == ["▁word", ",", "▁(word", ").", "▁...word"]


def test_what_pieces_join_to_letters_does_not_begin_a_segment():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        own = Merger(file.read())
    starters = own.starters()
    assert starters and not any(b in starters and a != "▁" and a not in starters for a, b in own.neighbours)
