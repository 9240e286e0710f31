"""SentencePiece BPE encoding by a prefix table, and decoding.

For a prefix of a chunk the table stores the one token that ends the prefix's encoding. It is filled
for the prefixes that a search comes to, which tries the longest piece first at the end of one: a
candidate is right if the last token of the prefix before it and the candidate are what the two
together encode to. A prefix that leads no further is left for good, for its encoding is the only
one. The ids are recovered backwards from the end of the table. Merges never cross from a visible
character to a following space mark (checked against the vocabulary), so that a text is cut there
and equal chunks are encoded once per worker.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

#: Fixed value: the mark that stands for a space.
SPACE = "▁"
#: Entries of a worker's tables, twice at most (see _Memo); longer chunks are not remembered.
MEMO, PAIR_MEMO = 250_000, 400_000
MEMO_CHARS = 48
#: Tokens of characters that are no piece are WIDE + code point; two tokens make one key.
WIDE, SHIFT = 1 << 20, 22
#: Characters that tell how long a piece may be that begins with them.
HEAD = 4


class _Memo(dict):
    """A bounded table filled on demand. A full one starts anew and falls back on what it held."""

    def __init__(self, make, limit):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if isinstance(key, int) or len(key) <= MEMO_CHARS:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Pieces:
    """Encoder and decoder of one model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        spec = model_pb2.ModelProto.FromString(model)
        norm = spec.normalizer_spec
        kinds = {p.type for p in spec.pieces} - {1, 2, 3, 6}
        if (
            spec.trainer_spec.model_type != 2
            or not spec.trainer_spec.byte_fallback
            or spec.trainer_spec.treat_whitespace_as_suffix
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not (norm.add_dummy_prefix and norm.escape_whitespaces)
            or kinds
        ):
            raise ValueError("Only BPE models with byte fallback and identity rules are supported.")
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end = processor.eos_id()
        self.score, self.ids, self.bytes_of = {}, {}, [0] * 256
        parts: list[bytes] = []
        # the longest piece that begins with the same HEAD characters
        self.reach: dict[str, int] = {}
        for i, p in enumerate(spec.pieces):
            if p.type == 1:
                self.ids[p.piece] = i
                self.score[p.piece] = p.score
                head = p.piece[:HEAD]
                self.reach[head] = max(self.reach.get(head, 0), len(p.piece))
                parts.append(p.piece.replace(SPACE, " ").encode())
            elif p.type == 6:
                value = int(p.piece[1:-1], 16)
                self.bytes_of[value] = i
                parts.append(bytes([value]))
            else:
                parts.append(b"" if p.type == 3 else spec.trainer_spec.unk_surface.encode())
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.lengths = np.array([len(p) for p in parts], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.names = [p.piece for p in spec.pieces]
        self.alphabet = {p for p in self.ids if len(p) == 1}
        self.pairs = _Memo(self._fits, PAIR_MEMO)
        self.singles = _Memo(lambda t: self.merged(self._text(t)) == [self._text(t)], MEMO)
        self.chunks = _Memo(self._chunk_bytes, MEMO)
        self.plain = _Memo(self._word_bytes, MEMO)
        # a line end that is in no piece is a cut like a space, and its own bytes
        self.line_end = None
        if not any("\n" in p for p in self.ids):
            self.line_end = np.array([self.bytes_of[10]], dtype=np.int32).tobytes()

    def merged(self, text: str) -> list[str]:
        """What a short string merges to: always the best pair, the leftmost of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def tokens(self, chunk: str) -> list[int]:
        """Tokens of a chunk, those of unknown characters as WIDE + code point.

        Fills the prefix table where the search comes to, then walks it backwards. Every prefix is
        come to once at most, and no more pieces are tried at its end than a piece has characters.
        """
        n = len(chunk)
        last, size, left = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        ids, reach, singles, pairs = self.ids, self.reach, self.singles, self.pairs
        at, length = 0, min(reach.get(chunk[:HEAD], HEAD - 1), n)
        while at < n:
            while length:
                end = at + length
                # a prefix that was come to before leads no further
                if not size[end]:
                    token = ids.get(chunk[at:end])
                    if token is None and length == 1:
                        token = WIDE + ord(chunk[at])
                    if token is not None and (pairs[last[at] << SHIFT | token] if at else singles[token]):
                        break
                length -= 1
            if length:
                last[end], size[end], left[at] = token, length, length - 1
                at, length = end, min(reach.get(chunk[end : end + HEAD], HEAD - 1), n - end)
            elif at:
                at -= size[at]
                length = left[at]
            else:
                raise ValueError("A prefix has no last token.")
        out = []
        while n > 0:
            out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def _text(self, token: int) -> str:
        return chr(token - WIDE) if token >= WIDE else self.names[token]

    def _fits(self, key: int) -> bool:
        a, b = self._text(key >> SHIFT), self._text(key & ((1 << SHIFT) - 1))
        return self.merged(a + b) == [a, b]

    def _chunk_bytes(self, chunk: str) -> bytes:
        tokens = self.tokens(chunk)
        if max(tokens, default=0) < WIDE:
            return array("i", tokens).tobytes()
        ids: list[int] = []
        for token in tokens:
            if token >= WIDE:
                ids.extend(self.bytes_of[b] for b in chr(token - WIDE).encode())
            else:
                ids.append(token)
        return array("i", ids).tobytes()

    def _word_bytes(self, word: str) -> bytes:
        """A word that follows a space, cut at line ends where no piece has one."""
        if self.line_end is None or "\n" not in word:
            return self._chunk_bytes(SPACE + word)
        first, *rest = word.split("\n")
        parts = [self.plain[first]]
        for line in rest:
            parts.append(self.line_end)
            if line:
                parts.append(self.chunks[line])
        return b"".join(parts)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers, without the end id."""
        if not text:
            return b""
        if not self.cuts:
            return self._chunk_bytes(SPACE + text.replace(" ", SPACE))
        if SPACE in text or "  " in text or text[0] == " ":
            marked = SPACE + text.replace(" ", SPACE)
            chunks = re.findall(f"{SPACE}+[^{SPACE}]*", marked)
            return b"".join(map(self.chunks.__getitem__, chunks))
        return b"".join(map(self.plain.__getitem__, text.split(" ")))

    def decode(self, ids: np.ndarray) -> str:
        """Text of a list of ids; control ids vanish, broken bytes become U+FFFD."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        where = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)
        data = self.blob[where].tobytes()
        return (data[1:] if data.startswith(b" ") else data).decode("utf-8", "replace")


_LOADED: dict[int, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    key = hash(model)
    if key not in _LOADED:
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


def _model(df: DataFrame, path: str):
    """The model file (some 500 kB) as a broadcast value; the driver reads it."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_texts(docs: DataFrame, model_path: str, *, end: bool = True) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, one row per row of docs (doc_id, text).

    NULL and empty texts have the end id only. NULL ids and repeated rows are encoded like any
    other row, an empty table gives an empty result, other columns are ignored. Texts of any
    length are encoded in time and memory proportional to their length.
    """
    model = _model(docs, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model.value)
        tail = np.array([pieces.end] if end else [], dtype=np.int32).tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                coded = [pieces.encode(t or "") + tail for t in part.column(1).to_pylist()]
                offsets = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
                )
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>"
    )


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, text): the ids with the text they stand for; NULL ids give an empty text."""
    model = _model(encoded, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = []
                for row in part.column(1):
                    ids = row.values
                    texts.append(
                        "" if ids is None else pieces.decode(ids.to_numpy(zero_copy_only=False))
                    )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {kind}, ids array<int>, text string"
    )
