"""SentencePiece (BPE) encoding and decoding with a prefix table.

For every prefix of a word the encoding's last token is unique. An
automaton lists the tokens that end at each position; a token t that
starts at j is the last token of the prefix exactly if j is 0 or (last
token of the prefix of length j, t) is a compatible pair: merging their
joined characters gives back those two tokens. The table of last tokens
is filled from left to right and the ids are read from its end backwards.

No piece of the vocabulary crosses from a letter into a following space
mark (checked on loading), so each run of spaces with the letters after
it is encoded on its own, and characters without a piece become byte
pieces. Null texts are empty and have no ids; texts of any length are
encoded whole; repeated rows give repeated results.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import BLOCK_BYTES, KEPT, give_back

SPACE = "▁"
MEMO = 250_000  # entries of a generation; a memo holds at most two
MEMO_CHARS = 48  # longer words are not remembered


class Memo(dict):
    """A function's results. When full it becomes the older generation;
    entries asked for again move to the younger one."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if isinstance(key, str) and len(key) > MEMO_CHARS:
                return value
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceEncoder:
    """Encoder for a sentencepiece BPE model file with byte fallback."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        sp = self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.piece = {i: sp.id_to_piece(i) for i in ids}
        self.id = {p: i for i, p in self.piece.items()}
        self.score = {p: sp.get_score(i) for i, p in self.piece.items()}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not sp.is_byte(i) for i in self.byte):
            raise ValueError("the model has no byte pieces")
        chars = {c for p in self.id for c in p}
        if not chars <= set(self.id) or any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id):
            raise ValueError("a piece has a character without a piece, or a letter before a space mark")
        self.chars = chars
        self.automaton = ahocorasick.Automaton()
        self.ids = sp.get_piece_size()
        for p, i in self.id.items():
            self.automaton.add_word(p, (len(p), i, i * self.ids))
        self.automaton.make_automaton()
        self.history = {i: self.merges(p) for i, p in self.piece.items()}
        self.compatible = Memo(self.pair_keeps)
        self.packed = Memo(lambda word: array("i", self.word_ids(SPACE + word)).tobytes())
        self.runs = re.compile("(?: ( *[^ ]+)| ( *))")

    def merges(self, text: str) -> list[tuple[float, str, str]]:
        """(score, first part, last part) after each merge of ``text``, in
        order: best score first, leftmost on ties. The start has score 0."""
        parts = list(text)
        out = [(0.0, parts[0], parts[-1])]
        while True:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                return out
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            out.append((best[0], parts[0], parts[-1]))

    def pair_keeps(self, pair: int) -> bool:
        """Whether no merge joins two tokens (left * ids + right) side by
        side: both merge in best-first order, and a merge across their
        border comes first if it scores better than the left one's next
        merge and no worse than the right one's."""
        left, right = (self.history[i] for i in divmod(pair, self.ids))
        i = j = 0
        while True:
            across = self.score.get(left[i][2] + right[j][1])
            a = left[i + 1][0] if i + 1 < len(left) else -np.inf
            b = right[j + 1][0] if j + 1 < len(right) else -np.inf
            if across is not None and across > a and across >= b:
                return False
            if a == b == -np.inf:
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def known(self, text: str) -> list[int]:
        """Ids of a string whose characters all have pieces."""
        last: list = [None] * len(text)  # of the prefix that ends there; every prefix has one
        compatible, done = self.compatible, -1
        for end, piece in self.automaton.iter(text):
            if end != done:
                before = end - piece[0]
                if before < 0 or compatible[last[before][2] + piece[1]]:
                    last[end], done = piece, end
        out, at = [], len(text) - 1
        while at >= 0:
            length, token, _ = last[at]
            out.append(token)
            at -= length
        out.reverse()
        return out

    def word_ids(self, word: str) -> list[int]:
        word = word.replace(" ", SPACE)
        if self.chars.issuperset(word):
            return self.known(word)
        out: list[int] = []
        begin = 0
        for k, c in enumerate(word):
            if c not in self.chars:
                out += self.known(word[begin:k]) if k > begin else []
                out += [self.byte[b] for b in c.encode()]
                begin = k + 1
        return out + (self.known(word[begin:]) if begin < len(word) else [])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text (int32), as the library's encode without begin and end."""
        if not text:
            return np.zeros(0, np.int32)
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            # a run of spaces belongs to the word after it
            words = [a or b for a, b in self.runs.findall(" " + text)]
        else:
            words = text.split(" ")
        return np.frombuffer(b"".join(map(self.packed.__getitem__, words)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist()) if len(ids) else ""


@lru_cache(maxsize=2)
def encoder(model_file: str) -> PieceEncoder:
    """One encoder per worker process and model, until a task of another
    operator comes: its memo would add to what that one takes."""
    return PieceEncoder(model_file)


def forget() -> None:
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        gc.collect()
        give_back()


KEPT.append(forget)


def encode_decode(df: DataFrame, model_file: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``df`` with ``ids`` (array of int) and
    ``decoded`` (string) of the text column. No shuffle."""
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_file)
        for batch in batches:
            texts = batch.column(len(names))
            begin, held = 0, 0
            ids: list[np.ndarray] = []
            back: list[str] = []
            for k in range(len(texts)):
                text = texts[k].as_py() or ""
                ids.append(enc.encode(text))
                back.append(enc.decode(ids[-1]))
                held += len(text)
                if held >= BLOCK_BYTES or k + 1 == len(texts):
                    offsets = np.zeros(len(ids) + 1, np.int32)
                    np.cumsum([len(x) for x in ids], out=offsets[1:])
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                    own = [batch.column(i).slice(begin, len(ids)) for i in range(len(names))]
                    yield pa.RecordBatch.from_arrays([*own, lists, pa.array(back, pa.string())], names=[*names, "ids", "decoded"])
                    begin, held, ids, back = k + 1, 0, [], []
        give_back()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields + ', ' if fields else ''}ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """The digest columns of :func:`encode_decode` rows."""
    return encoded.withColumns({
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join("ids", ","), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    }).drop("ids", "decoded")
