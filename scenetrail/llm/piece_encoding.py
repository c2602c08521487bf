"""SentencePiece BPE ids by backtracking, and their text again.

A sequence of pieces is what the merges of a BPE model give if, and only if, each two neighbours are: merging their joined
text again must end in the same two pieces. So no merge is run over a text. An Aho-Corasick automaton finds the longest
piece at every place; a text is walked from left to right with the longest piece that suits the one before it, then
with shorter ones; where none is left, the place is marked as failed in a bitfield and the last piece is taken back.

No piece holds a space after another character, so texts are cut where a word ends, and beside characters that are in no
longer piece, such as line feeds; a word that a task has met before is not walked again. The library is not used to encode or decode; it only reads the vocabulary.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetrail.llm.common import boxed, by_bytes, query, table, unboxed
from scenetrail.llm.words import list_column

SPACE = "▁"  # the model's mark for a space
NONE, FIRST = -1, -2  # instead of an id: nothing is left, the first character is left
CHARACTER = 1 << 21  # and a code point stand for a character that is no piece
KNOWN_WORDS = 500_000  # that a task remembers, at about 220 bytes
KNOWN_PAIRS = 1_000_000
LONG_WORD = 64  # characters; longer words are not remembered
PART = 1 << 16  # characters whose words are held at once, and what is left of the last word
_WORD_END = re.compile("[^ ](?= )")
_NO_PIECE = " \u2047 ".encode()  # what the library gives for the unknown id


def merged(text: str, score: dict[str, float]) -> tuple[list[str], list[tuple[float, str, str]]]:
    """What merging a short text gives, and its merges in order: score, first and last symbol before it.

    The pair with the best joined piece goes first, the leftmost of equals.
    """
    parts, merges = list(text), []
    while len(parts) > 1:
        best, at = None, -1
        for k in range(len(parts) - 1):
            found = score.get(parts[k] + parts[k + 1])
            if found is not None and (best is None or found > best):
                best, at = found, k
        if best is None:
            break
        merges.append((best, parts[0], parts[-1]))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts, merges


def _stages(merges: list[tuple[float, str, str]], side: int, piece: str) -> tuple[tuple[str, float], ...]:
    """The symbols that stand first (1) or last (2) in a piece while it is merged, each with its least score until it goes."""
    out: list[tuple[str, float]] = []
    for merge in merges:
        if out and out[-1][0] == merge[side]:
            out[-1] = merge[side], min(out[-1][1], merge[0])
        else:
            out.append((merge[side], merge[0]))
    if out and out[-1][0] == piece:
        out.pop()
    return (*out, (piece, float("-inf")))


class Vocabulary:
    """Pieces of a BPE model with byte fallback, as plain tables that can be sent to the tasks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        control = {i for i in ids if model.is_control(i)}
        plain = [i for i in ids if not (i in control or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = {model.id_to_piece(i): i for i in plain}
        self.score = {p: model.get_score(i) for p, i in self.pieces.items()}
        if len(self.bytes) != 256 or model.normalize(" a  \u00e9\ufb01 ") != f"{SPACE * 2}a{SPACE * 2}\u00e9\ufb01{SPACE}":
            raise ValueError("the model must have byte fallback, a space put in front, and no other normalization")
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece holds a space after another character")
        # A piece that its own merges do not lead to never comes out of a model.
        made = {p: merged(p, self.score) for p in self.pieces}
        self.border = {self.pieces[p]: (_stages(merges, 1, p), _stages(merges, 2, p)) for p, (parts, merges) in made.items() if parts == [p]}
        self.piece = [model.id_to_piece(i) for i in ids]
        # The next shorter piece at the same place; FIRST is a first character, which stands for itself if it is no piece.
        self.shorter = [NONE] * len(self.piece)
        for i in self.border:
            p = self.piece[i]
            shorter = [self.pieces[p[:n]] for n in range(len(p) - 1, 0, -1) if self.pieces.get(p[:n]) in self.border]
            self.shorter[i] = shorter[0] if shorter else FIRST if len(p) > 1 else NONE
        self.text = [b"" if i in control else _NO_PIECE for i in ids]
        for piece, i in self.pieces.items():
            self.text[i] = piece.replace(SPACE, " ").encode()
        for byte, i in self.bytes.items():
            self.text[i] = bytes([byte])
        self.put_in_front = {i for p, i in self.pieces.items() if p[0] == SPACE}
        self.silent = control


    def word_pattern(self) -> re.Pattern:
        """Words, with the spaces before them, and runs of ASCII characters that are in no piece with another one."""
        joined = set("".join(p for p in self.pieces if len(p) > 1))
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined and c != 32)
        return re.compile(f" *[^ {alone}]+| +|[{alone}]+" if alone else " *[^ ]+| +")


class Encoder:
    """Ids of texts as the bytes of 32-bit numbers."""

    def __init__(self, vocabulary: Vocabulary):
        self.score, self.border, self.shorter = vocabulary.score, vocabulary.border, vocabulary.shorter
        self.piece = vocabulary.piece
        self.size = [len(p) for p in self.piece]
        self.find = ahocorasick.Automaton()
        for i in self.border:
            self.find.add_word(self.piece[i], (self.size[i] - 1, i))
        self.find.make_automaton()
        self.single = {p: i for p, i in vocabulary.pieces.items() if len(p) == 1}
        self.bytes = vocabulary.bytes
        self.split = vocabulary.word_pattern().findall
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    def suits(self, left: int, right: int) -> bool:
        """Whether two pieces stay apart when their joined text is merged again.

        Up to the first merge across the border, each side goes on as it does alone, the better score first and the
        left one of equals. So it is enough to see, for each two symbols that meet at the border, whether they make a
        piece before one of them goes.
        """
        score, i, j = self.score, 0, 0
        on_left = self.border[left][1] if left < CHARACTER else ((chr(left - CHARACTER), float("-inf")),)
        on_right = self.border[right][0] if right < CHARACTER else ((chr(right - CHARACTER), float("-inf")),)
        while True:
            last, until_left = on_left[i]
            first, until_right = on_right[j]
            across = score.get(last + first)
            if across is not None and across > until_left and across >= until_right:
                return False
            if until_left < until_right:
                j += 1
            elif i + 1 < len(on_left):
                i += 1
            else:
                return True

    def walk(self, word: str) -> list[int]:
        """Ids of a word; CHARACTER and the code point for a character that is no piece."""
        n = len(word)
        longest = array("i", [NONE]) * (n + 1)
        for last, (before, token) in self.find.iter(word):  # of one start, the longer ones come later
            longest[last - before] = token
        size_of = self.size
        token = longest[0]
        if token >= 0 and size_of[token] == n:
            return [token]
        failed = bytearray((n >> 3) + 1)
        pairs, shorter = self.pairs, self.shorter
        out: list[int] = []
        at = 0
        while at < n:
            if token < 0:  # no piece begins here, or only the first character of one is left
                token = self.single.get(word[at], CHARACTER + ord(word[at]))
            end = at + (size_of[token] if token < CHARACTER else 1)
            if not failed[end >> 3] >> (end & 7) & 1:
                if out:
                    pair = out[-1] << 32 | token
                    suits = pairs.get(pair)
                    if suits is None:
                        if len(pairs) >= KNOWN_PAIRS:
                            pairs.clear()
                        suits = pairs[pair] = self.suits(out[-1], token)
                else:
                    suits = True
                if suits:
                    out.append(token)
                    at = end
                    token = longest[at]
                    continue
            token = shorter[token] if token < CHARACTER else NONE
            while token == NONE:  # nothing fits here: take back the last piece and try a shorter one
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                at -= size_of[token] if token < CHARACTER else 1
                token = shorter[token] if token < CHARACTER else NONE
        return out

    def word(self, word: str) -> bytes:
        """Ids of a word with the spaces before it."""
        ids = self.walk(word.replace(" ", SPACE))
        if max(ids) >= CHARACTER:
            ids = [i for token in ids for i in ([token] if token < CHARACTER else [self.bytes[b] for b in chr(token - CHARACTER).encode()])]
        found = array("i", ids).tobytes()
        if len(word) <= LONG_WORD:
            if len(self.words) >= KNOWN_WORDS:
                self.words.clear()
            self.words[word] = found
        return found

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        get, new = self.words.get, self.word
        return b"".join([b"".join([get(w) or new(w) for w in self.split(part)]) for part in _parts(" " + text.replace(SPACE, " "))])


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that end where a word ends, so that few of its words are held at once."""
    at = 0
    while at < len(text):
        end = _WORD_END.search(text, at + PART)
        to = end.end() if end else len(text)
        yield text[at:to]
        at = to


def decoder(vocabulary: Vocabulary):
    """A function from ids to their text, as the library gives it."""
    text = vocabulary.text
    byte_of = {i: b for b, i in vocabulary.bytes.items()}

    def decode(ids: list[int]) -> str:
        raw = b"".join([text[i] for i in ids])
        first = next((i for i in ids if i not in vocabulary.silent), None)
        begin = int(first in vocabulary.put_in_front)
        try:
            return raw[begin:].decode()
        except UnicodeDecodeError:  # ids of other origin: each byte that belongs to no character is replaced
            out, run = [], bytearray()
            for i in [*ids, None]:
                if i in byte_of:
                    run.append(byte_of[i])
                    continue
                out.append(_characters(bytes(run)))
                run.clear()
                if i is not None:
                    out.append(text[i].decode())
            return "".join(out)[begin:]

    return decode


def _characters(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("\ufffd")
            size = 1
        at += size
    return "".join(out)


def _id_lists(texts: pa.Array, encoder: Encoder) -> pa.Array:
    ids = [encoder(t.as_py() or "") for t in texts]
    return list_column(np.frombuffer(b"".join(ids), "<i4"), np.array([len(i) >> 2 for i in ids], np.int64), pa.int32())


def _texts(ids: pa.Array, decode) -> pa.Array:
    flat, ends = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())])
    return pa.array([decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])], pa.string())


def piece_ids(text: Column, path: str) -> Column:
    """Ids of a text as an array of int; null counts as empty, which has none.

    Linear in the text but for what is taken back, which is at most a few pieces at a place. A task holds the ids of a
    batch and of one text, and words and pairs of pieces up to a fixed number.
    """
    vocabulary = Vocabulary(path)

    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary)
        for column in columns:
            yield _id_lists(column, encoder)

    return by_bytes(encode, "array<int>")(text)


def piece_text(ids: Column, path: str) -> Column:
    """Text of an array of ids without null elements; a null array gives empty text."""
    vocabulary = Vocabulary(path)

    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        text = decoder(vocabulary)
        for column in columns:
            yield _texts(column, text)

    return by_bytes(decode, "string")(ids)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """The columns of ``docs`` and ids array<int>, decoded string, for every row; these two replace columns of their names.

    Null text counts as empty, with no ids and an empty decoded text. Repeated rows each give a row; an empty table
    gives none. ``path`` is a SentencePiece BPE model with byte fallback that only puts a space in front. The ids are
    decoded by the task that made them.
    """
    vocabulary = Vocabulary(path)

    def both(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decode = Encoder(vocabulary), decoder(vocabulary)
        for column in columns:
            ids = _id_lists(column, encoder)
            yield pa.StructArray.from_arrays([ids, _texts(ids, decode)], ["ids", "decoded"])

    made = by_bytes(both, "struct<ids:array<int>,decoded:string>")
    found = boxed(docs).withColumn("_made", made(F.col("_row.text")))
    return unboxed(found, docs.columns, ids=F.col("_made.ids"), decoded=F.col("_made.decoded"))


@query("op12_piece_encoding")
def op12_piece_encoding(spark, sf_dir):
    import public_tokenizers

    found = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
