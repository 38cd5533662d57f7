"""SentencePiece (merge type): exact encoding by backtracking, and decoding.

Merging takes the best-scored adjacent pair whose joined text is a piece, the leftmost on ties, until
none is left.  The result is the only sequence of tokens in which every two neighbours, merged anew from
their characters, come out as these two: were a merge to cross a border of such a sequence, the first one
to do so would also be the first choice between the two neighbours alone.  So a text needs no merging:

* one Aho-Corasick pass lists the pieces that start at each character;
* from left to right the longest piece is taken that is compatible with the token before it, which is
  tested by re-merging the two tokens' characters (the answers are kept);
* where no piece fits, the position is marked in a bitfield of failed positions and the token before it is
  replaced by its next shorter prefix.  The encoding of a prefix is unique, so a position that failed
  once never has to be tried again.

Texts are normalised as the model says.  No merge crosses two characters that are neighbours in no piece; texts
are cut at such places as far as the vocabulary shows them (letters against punctuation, words against spaces), and
the encodings of the segments are kept in a bounded table.  Characters without a piece become byte
pieces where the model has these, else the unknown id (a run of them is one).

Edge cases: null text is empty; an empty text has no ids and decodes to the empty text; texts of any length
are encoded whole; control strings such as ``</s>`` in a text are ordinary text; rows that repeat are each
encoded; an empty table gives an empty result; columns other than the key and the text are not read.
Models with user-defined or unused pieces are not of this kind and raise an error.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
#: Bounds of what a worker keeps: words (of at most WORD_CHARS) with their ids, twice, and pairs of tokens.
WORDS, WORD_CHARS, PAIRS = 500_000, 64, 1_000_000
#: A result batch is sent once it holds so many ids.
BATCH_IDS = 1_000_000
_SPACE = "▁"
_NONE = float("-inf")


def model_bytes(path: str | None = None) -> bytes:
    """The model file, read on the driver; tasks get its bytes (half a megabyte)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    with open(path, "rb") as f:
        return f.read()


def _cuts(pieces) -> str:
    """A pattern of segments that no piece reaches out of.

    Characters that are neighbours in some piece are of one kind; two characters of different kinds
    are never merged, nor are any character and a space mark behind it where no piece has such a pair.
    """
    if any(_SPACE in piece.lstrip(_SPACE) for piece in pieces):
        return r"(?s).+"
    kind: dict[str, str] = {}

    def find(c: str) -> str:
        while kind.setdefault(c, c) != c:
            kind[c] = c = kind[kind[c]]
        return c

    pairs = {(a, b) for piece in pieces for a, b in zip(piece.lstrip(_SPACE), piece.lstrip(_SPACE)[1:])}
    for a, b in pairs:
        kind[find(a)] = find(b)
    kinds: dict[str, str] = {}
    for c in sorted(kind):
        kinds[find(c)] = kinds.get(find(c), "") + c
    runs = [f"[{re.escape(''.join(k))}]+" for k in sorted(kinds.values(), key=len, reverse=True)]
    return f"(?s){_SPACE}*(?:{'|'.join([*runs, f'[^{_SPACE}]'])})|{_SPACE}+"


class Encoder:
    """Ids of texts under one merge-type model."""

    def __init__(self, model: bytes):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: list[int] | None = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.bytes):
            self.bytes = None
        for i in range(sp.vocab_size()):
            if sp.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
                piece = sp.id_to_piece(i)
                self.ids[piece], self.scores[piece] = i, sp.get_score(i)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for piece in self.ids:
            self.automaton.add_word(piece)
        self.automaton.make_automaton()
        self.cut = re.compile(_cuts(self.ids))
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    @classmethod
    def of_worker(cls, model: bytes) -> Encoder:
        """This worker's encoder.  A class that is sent by value is one object in a worker, so the tables
        that a task has filled serve the worker's later tasks of the job."""
        if getattr(cls, "_model", None) != model:
            cls._model, cls._encoder = model, cls(model)
        return cls._encoder

    def merge(self, text: str) -> list[str]:
        """The tokens of a short text by merging (best score first, then leftmost)."""
        parts, score, none = list(text), self.scores.get, _NONE
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            at = pairs.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = score(parts[at] + parts[at + 1], none)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two tokens stay as they are when their characters are merged anew."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        fits = self.pairs[left, right] = self.merge(left + right) == ([left, right] if left else [right])
        return fits

    def tokens(self, text: str) -> list[str]:
        """The tokens of one segment, by backtracking."""
        n = len(text)
        starts = [2] * n  # bit k: a piece of k characters starts here; a character alone always can
        for end, length in self.automaton.iter(text):
            starts[end - length + 1] |= 1 << length
        failed = bytearray(n // 8 + 1)
        stack: list[tuple[str, int, int]] = []  # token, its start, the shorter pieces not tried yet
        pos, left, before, pairs = 0, starts[0] if n else 0, "", self.pairs
        while pos < n:
            while left:
                length = left.bit_length() - 1
                left ^= 1 << length
                end = pos + length
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                token = text[pos:end]
                fits = pairs.get((before, token))
                if fits or (fits is None and self.compatible(before, token)):
                    stack.append((token, pos, left))
                    before, pos = token, end
                    left = starts[pos] if pos < n else 0
                    break
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                if not stack:
                    raise AssertionError("no encoding")  # merging always yields one
                _, pos, left = stack.pop()
                before = stack[-1][0] if stack else ""
        return [token for token, _, _ in stack]

    def _ids(self, tokens: list[str]) -> list[int]:
        try:
            return list(map(self.ids.__getitem__, tokens))
        except KeyError:
            pass
        out: list[int] = []
        unknown = False
        for t in tokens:
            i = self.ids.get(t)
            if i is not None:
                out.append(i)
                unknown = False
            elif self.bytes:
                out += [self.bytes[b] for b in t.encode()]
            elif not unknown:
                out.append(self.sp.unk_id())
                unknown = True
        return out

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        segments = self.cut.findall(self.sp.normalize(text)) if text else []
        if self.bytes is None:  # runs of unknown characters may cross a cut
            return array("i", self._ids([t for s in segments for t in self.tokens(s)])).tobytes()
        out: list[bytes] = []
        for word in segments:
            ids = self.words.get(word)
            if ids is None:
                ids = self.older.get(word) or array("i", self._ids(self.tokens(word))).tobytes()
                if len(word) <= WORD_CHARS:
                    if len(self.words) >= WORDS:  # words not met again since the last turn are forgotten
                        self.older, self.words = self.words, {}
                    self.words[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids) if ids else ""


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: bytes | None = None) -> DataFrame:
    """(key, ids array<int>, decoded string), one row per row of ``docs``."""
    model = model or model_bytes()
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    keys = rows.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder.of_worker(model)
            start, flat, ends, texts = 0, bytearray(), array("i", [0]), []
            for row in range(batch.num_rows):
                ids = encoder.packed(batch.column(1)[row].as_py())
                flat += ids
                ends.append(len(flat) // 4)
                texts.append(encoder.decode(array("i", ids).tolist()))
                if len(flat) >= 4 * BATCH_IDS or row == batch.num_rows - 1:
                    values = pa.Array.from_buffers(pa.int32(), len(flat) // 4, [None, pa.py_buffer(bytes(flat))])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, row + 1 - start), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                         pa.array(texts, pa.string())], names=["_key", "ids", "decoded"])
                    start, flat, ends, texts = row + 1, bytearray(), array("i", [0]), []

    return rows.mapInArrow(run, f"_key {keys}, ids array<int>, decoded string").withColumnRenamed("_key", key)


def op11(docs: DataFrame, model: bytes | None = None) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encode(docs, model=model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
