"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps an agenda (heap) of adjacent symbol pairs that form a piece
of the vocabulary, ordered by score and then by place, and merges the best
pair until none is left.  Texts come in Arrow batches; ids are exact, as the
tests check against the sentencepiece library.

Work is per segment: a run of word-boundary marks and the characters up to the
next mark.  That is exact when no piece holds a mark after another character,
which `PieceBpe` checks when it loads a vocabulary (otherwise the whole text is
one segment).  Segments are remembered in two bounded generations.

Supported models: BPE, identity normaliser, dummy prefix, extra white space
kept, byte fallback, no user-defined pieces.  Others raise ValueError.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

MARK = "▁"
REMEMBERED = 300_000  # segments in each of the two generations
LONGEST_REMEMBERED = 64
SHORT = 48  # characters up to which a list serves as agenda
NEVER = 1 << 60
AT_ONCE = 512  # rows whose ids are held at once


class _Segments(dict):
    """Segment -> its ids as little-endian bytes; the younger of two
    generations, each of at most `REMEMBERED` segments."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.encode(key)
            if len(key) > LONGEST_REMEMBERED:
                return ids
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = ids
        return ids


class PieceBpe:
    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if (train.model_type != pb.TrainerSpec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or train.treat_whitespace_as_suffix or not train.byte_fallback
                or any(p.type == p.USER_DEFINED for p in proto.pieces)):
            raise ValueError("not a supported merge-type model")
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        self.surface, self.byte_ids, self.id_bytes, scores = [], {}, {}, {}
        self.marked, self.silent = set(), set()
        for i, p in enumerate(proto.pieces):
            packed = i.to_bytes(4, "little")
            if p.type == p.BYTE:
                value = int(p.piece[3:-1], 16)  # written <0xNN>
                self.byte_ids[value] = packed
                self.surface.append(bytes([value]))
            elif p.type == p.NORMAL:
                self.id_bytes[p.piece], scores[p.piece] = packed, p.score
                self.surface.append(p.piece.replace(MARK, " ").encode())
                if p.piece.startswith(MARK):
                    self.marked.add(i)
            elif p.type == p.UNKNOWN:
                self.surface.append(train.unk_surface.encode())
            else:
                self.surface.append(b"")
                self.silent.add(i)
        place = {x: k for k, x in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {piece: place[x] for piece, x in scores.items()}
        self.splits = not any(MARK in piece.lstrip(MARK) for piece in self.rank)
        joined = {ch for piece in self.rank if len(piece) > 1 for ch in piece}
        self.newline_alone = "\n" not in joined
        self.segments = _Segments(self._segment)

    # -- encoding ----------------------------------------------------------

    def _segment(self, key: str) -> bytes:
        """`key` is a segment without its first mark, other marks as spaces."""
        text = MARK + key.replace(" ", MARK)
        if self.newline_alone and "\n" in text:
            return b"".join(self.packed(x) for part in re.split("(\n)", text) if part for x in self.merged(part))
        return b"".join(map(self.packed, self.merged(text)))

    def packed(self, symbol: str) -> bytes:
        ids = self.id_bytes.get(symbol)
        return ids if ids is not None else b"".join(self.byte_ids[b] for b in symbol.encode())

    def merged(self, text: str) -> list[str]:
        """The symbols left when no adjacent pair forms a piece, in a text with
        marks for spaces.  Short texts keep the agenda as a list of the pairs'
        ranks in text order, long ones as a heap."""
        return self._merged_short(text) if len(text) <= SHORT else self._merged_long(text)

    def _merged_short(self, text: str) -> list[str]:
        rank = self.rank.get
        symbols = list(text)
        pairs = [rank(a + b, NEVER) for a, b in zip(text, text[1:])]
        while pairs and (best := min(pairs)) != NEVER:
            i = pairs.index(best)  # of equal scores the leftmost
            symbols[i:i + 2] = [piece] = [symbols[i] + symbols[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(symbols[i - 1] + piece, NEVER)
            if i < len(pairs):
                pairs[i] = rank(piece + symbols[i + 1], NEVER)
        return symbols

    def _merged_long(self, text: str) -> list[str]:
        rank = self.rank.get
        symbols = list(text)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(r, left, a + b) for left, (a, b) in enumerate(zip(text, text[1:])) if (r := rank(a + b)) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, left, piece = heapq.heappop(agenda)
            right = after[left]
            if not symbols[left] or right >= n or symbols[left] + symbols[right] != piece:
                continue  # one of the two was merged meanwhile
            symbols[left], symbols[right] = piece, ""
            follow, ahead = after[right], before[left]
            after[left] = follow
            if follow < n:
                before[follow] = left
                wider = piece + symbols[follow]
                if (r := rank(wider)) is not None:
                    heapq.heappush(agenda, (r, left, wider))
            if ahead >= 0:
                wider = symbols[ahead] + piece
                if (r := rank(wider)) is not None:
                    heapq.heappush(agenda, (r, ahead, wider))
        return [x for x in symbols if x]

    def encode(self, text: str | None, ends: bool = True) -> bytes:
        """Ids of a text as little-endian 32-bit integers; null is empty."""
        first, last = (i.to_bytes(4, "little") if ends else b"" for i in (self.begin, self.end))
        if not text:
            return first + last
        if MARK in text:
            text = text.replace(MARK, " ")
        if not self.splits:
            return first + self._segment(text) + last
        keys = text.split(" ")
        if "" in keys:
            keys = re.findall(" *[^ ]+| +$", " " + text)
            keys = [k[1:] for k in keys]
        return first + b"".join(map(self.segments.__getitem__, keys)) + last

    # -- decoding ----------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids: begin and end ids are silent, the space
        that encoding puts first goes, bytes that are no UTF-8 become U+FFFD."""
        out = b"".join(map(self.surface.__getitem__, ids))
        if out.startswith(b" ") and next((i for i in ids if i not in self.silent), None) in self.marked:
            out = out[1:]
        return out.decode("utf-8", "replace")


_loaded: dict[str, PieceBpe] = {}


def tokenizer(model: bytes) -> PieceBpe:
    """The tokenizer of a model's bytes, kept for the life of the worker."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _loaded:
        _loaded[key] = PieceBpe(model)
    return _loaded[key]


def read_model(path: str) -> bytes:
    """The tokenizer file, a local file of the driver (under 1 MB); tasks get
    its bytes with their code."""
    with open(path, "rb") as f:
        return f.read()


def encode_batch(bpe: PieceBpe, texts: pa.Array, ends: bool = True) -> pa.ListArray:
    parts = [bpe.encode(t.as_py(), ends) for t in texts]
    lengths = np.fromiter((len(p) // 4 for p in parts), "i8", len(parts))
    offsets = np.zeros(len(parts) + 1, "i4")
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def decode_batch(bpe: PieceBpe, ids: pa.Array) -> pa.Array:
    return pa.array((bpe.decode(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else []) for x in ids), pa.string())


def _with_column(df: DataFrame, model: bytes, out: str, kind, make) -> DataFrame:
    schema = StructType([f for f in df.schema.fields if f.name != out] + [StructField(out, kind)])
    names = schema.fieldNames()[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [make(bpe, b)], [*names, out])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, model_path: str, text_col: str = "text", out: str = "ids", ends: bool = True) -> DataFrame:
    """Adds (or replaces) the column `out` with each whole text's ids, with
    begin and end ids if `ends`.  A null text counts as empty."""
    return _with_column(df, read_model(model_path), out, ArrayType(IntegerType()),
                        lambda bpe, b: encode_batch(bpe, b.column(text_col), ends))


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """Adds (or replaces) the column `out` with the text of each list of ids;
    null ids give an empty text."""
    return _with_column(df, read_model(model_path), out, StringType(),
                        lambda bpe, b: decode_batch(bpe, b.column(ids_col)))


def round_trip_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens (all ids), ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers), decoded_sha256 (of the decoded
    text in UTF-8).  Null texts count as empty, rows that repeat give a row
    each, an empty table gives none; other columns are not read."""
    model = read_model(model_path)
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    schema = StructType([docs.schema["doc_id"], StructField("n_tokens", LongType()),
                         StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(model)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for b in batches:
            counts, first, second = [], [], []
            for text in b.column("text"):
                ids = bpe.encode(text.as_py())
                counts.append(len(ids) // 4)
                first.append(sha(ids))
                second.append(sha(bpe.decode(np.frombuffer(ids, "<u4").tolist()).encode()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(first, pa.string()),
                                              pa.array(second, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(run, schema)


def tokenised(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """`docs` without the text, and with ids (begin and end included),
    n_tokens, ids_sha256 and decoded_sha256 as in `round_trip_digests`; these
    replace columns of the same names.  Null texts count as empty."""
    model = read_model(model_path)
    added = StructType([StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()),
                        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
    kept = [f for f in docs.schema.fields if f.name not in {text_col, *added.fieldNames()}]
    docs = docs.select(*[docs[f.name] for f in kept], docs[text_col].alias("ids"))  # the text, under a name that is free
    schema = StructType(kept + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(model)
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                b = whole.slice(at, AT_ONCE)
                ids = encode_batch(bpe, b.column("ids"))
                values, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
                rows = [values[s:e] for s, e in zip(ends[:-1], ends[1:])]
                sha = lambda data: hashlib.sha256(data).hexdigest()
                columns = [ids, pa.array([len(r) for r in rows], pa.int64()), pa.array([sha(r.astype("<u4").tobytes()) for r in rows], pa.string()),
                           pa.array([sha(bpe.decode(r.tolist()).encode()) for r in rows], pa.string())]
                yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], *columns], schema.fieldNames())

    return docs.mapInArrow(run, schema)
