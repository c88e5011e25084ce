"""What a task remembers is bounded by an argument, and the ids stay in the task where nobody wants them."""

import public_tokenizers

from shopgrain.llm import packing, tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_do_not_depend_on_what_is_remembered(docs, monkeypatch):
    texts = [f"some words {i} Übung, {i % 7}! again and again 北京 x{i * 31 % 997}" for i in range(300)]
    df = docs(*texts, None, "")
    whole = packing.token_pieces(df, WORDS, 16)
    few = packing.token_pieces(df, WORDS, 16, with_ids=False, remembered=4)
    cols = ["id", "piece", "start", "length", "ids_crc32"]
    assert few.columns == cols and whole.columns == [*cols, "ids"]
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, whole.select(*cols).collect()))


def test_an_encoder_holds_two_generations_at_most():
    encoder = tokens.WordEncoder(WORDS, remembered=8)
    encoder._TOGETHER = 1
    for _ in encoder(f"w{i} x{i}" for i in range(100)):
        held = [len(g) for s in (encoder.parts, encoder.pieces) for g in (s.young, s.old)]
        assert max(held) <= 8 + 8
