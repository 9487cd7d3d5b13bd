"""What workers keep between tasks."""

import public_tokenizers
import pyarrow as pa

from attrix.llm import kernels as K
from attrix.llm import op7_pieces as pieces


def test_other_operators_release_the_encoder():
    model = public_tokenizers.path("piece_bpe_32k.model")
    first = pieces.encoder(model)
    assert len(first.encode("some words")) and pieces.encoder(model) is first  # kept between its own tasks
    assert len(list(K.text_blocks(pa.array(["a", None])))) == 1
    assert pieces.encoder.cache_info().currsize == 0
    assert len(pieces.encoder(model).encode("some words"))
