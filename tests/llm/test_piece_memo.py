"""The encoder's memo of words and its prefix table."""

import public_tokenizers

from attrix.llm import op7_pieces as pieces


def test_memo_holds_many_words():
    made = []
    memo = pieces.Memo(lambda n: made.append(n) or n)
    for _ in range(2):
        assert all(memo[n] == n for n in range(220_000))
    assert len(made) == 220_000


def test_prefix_table_is_the_librarys():
    enc = pieces.PieceEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    for word in ["a", "ab", "undenteschü", "ciónqueíción%%%", "tkhmosli.19@mail9.example.com", "x" * 60, "toinorre***"]:
        assert enc.known("▁" + word) == enc.library.encode(word)
