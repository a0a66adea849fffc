"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed from its protobuf wire format; normaliser, metaspace
marker, scores and byte fallback are rebuilt as a `tokenizers.Tokenizer`
(unigram models from their scores, BPE models from the merges that the scores
imply). Where no piece has the marker inside, a text can be cut before each
run of markers without changing its encoding, so workers encode the distinct
chunks of a batch, multithreaded and many chunks to a string, and look the rest
up. Every chunk that is encoded is also given to the sentencepiece library;
documents with a chunk on which the two differ are flagged, and keep the ids of
this backend.

Defined cases: a null text encodes to no ids and decodes to the empty text; a
null doc_id is carried along; repeated rows get a result row each; an empty
table gives an empty result; other columns are ignored."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm._common import lean

MARK = "▁"
#: Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Bytes of each of the two generations of chunks that a worker remembers, and
#: what an entry takes besides its text and ids.
REMEMBERED, ENTRY = 16 << 20, 200
#: Texts encoded at a time, chunks encoded as one string, and threads (as many as
#: the task has cores, two at least).
BATCH, TOGETHER, THREADS = 500, 500, 2
#: Chunks longer than this are encoded but not remembered.
LONG_CHUNK = 64


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    extra_spaces: bool = True
    escape_spaces: bool = True
    suffix: bool = False

    @property
    def unknown(self) -> int:
        return self.types.index(UNKNOWN)

    @property
    def splits(self) -> bool:
        """No piece holds the marker after another character."""
        return not self.suffix and all(MARK not in p.lstrip(MARK) for p, t in zip(self.pieces, self.types) if t in (NORMAL, USER, UNUSED))


def _wire(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protobuf message."""

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"wire type {kind} in a SentencePiece model")
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        if at + size > len(data):
            raise ValueError("the SentencePiece model is cut short")
        yield tag >> 3, data[at : at + size]
        at += size


def parse(data: bytes) -> Model:
    model = Model()
    for number, value in _wire(data):
        if number == 1:
            piece = dict(_wire(value))
            model.pieces.append(piece.get(1, b"").decode("utf-8"))
            model.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            model.types.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_wire(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
            model.suffix = bool(trainer.get(24, 0))
        elif number == 3:
            normal = dict(_wire(value))
            model.charsmap = normal.get(2, b"")
            model.dummy_prefix, model.extra_spaces, model.escape_spaces = (bool(normal.get(i, 1)) for i in (3, 4, 5))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    return model


def tokenizer(model: Model, chunks: bool = False):
    """The model as a tokenizers.Tokenizer; with `chunks`, without normaliser,
    for texts that are normalised and cut already."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        core = models.Unigram(list(zip(model.pieces, model.scores)), model.unknown, model.byte_fallback)
    else:
        ids = {p: i for i, p in enumerate(model.pieces)}
        mergeable = {p for p, t in zip(model.pieces, model.types) if t in (NORMAL, USER, UNUSED)}
        merges = []
        for p in mergeable:
            pairs = [(p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in mergeable and p[i:] in mergeable]
            merges += [(-model.scores[ids[p]], ids[p], ids[a], ids[b], (a, b)) for a, b in pairs]
        core = models.BPE(ids, [m[-1] for m in sorted(merges)], unk_token=model.pieces[model.unknown], fuse_unk=True, byte_fallback=model.byte_fallback)
    out = Tokenizer(core)
    if not chunks:
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.extra_spaces:
            steps += [normalizers.Replace(Regex(r"^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if model.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if model.escape_spaces:
            steps.append(normalizers.Replace(" ", MARK))
        out.normalizer = normalizers.Sequence(steps)
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])])
    return out


class Codec:
    """Encodes and decodes batches of whole texts with one model file."""

    def __init__(self, data: bytes, check: bool = True):
        self.model = parse(data)
        self.whole = tokenizer(self.model)
        self.chunk = tokenizer(self.model, chunks=True)
        self.normalise = self.whole.normalizer.normalize_str
        self.plain = not (self.model.charsmap or self.model.extra_spaces) and self.model.dummy_prefix and self.model.escape_spaces
        byte = [int(p[1:-1], 16) if t == BYTE else -1 for p, t in zip(self.model.pieces, self.model.types)]
        raw = [bytes([b]) if b >= 0 else p.replace(MARK, " ").encode("utf-8") for p, b in zip(self.model.pieces, byte)]
        # All pieces' bytes in one table: where each begins, and how long it is.
        self.table = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.sizes = np.array([len(r) for r in raw], dtype=np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.begins = np.array([p.startswith(MARK) for p in self.model.pieces])
        self.reference = None
        if check:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.splits = self.model.splits
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0  # bytes of `known`
        self.wrong: set[str] = set()

    def chunks(self, text: str) -> list[str]:
        """Cuts a text before each run of markers; joined they are the
        normalised text."""
        if not text:
            return []
        if self.plain and MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return (MARK + text.replace(" ", " " + MARK)).split(" ")
        text = self.normalise(text)
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", text) if self.splits else [text] * bool(text)

    def _each(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks, 4 bytes each, by encoding one after the other."""
        found = {c: np.array(e.ids, dtype="<i4").tobytes() for c, e in zip(chunks, self.chunk.encode_batch_fast(chunks, add_special_tokens=False))}
        if self.reference is not None and self.plain:
            # The library puts one marker before what it is given and turns blanks into
            # markers; nothing gives it a marker alone, which is a piece or a byte run anyway.
            known = [c for c in chunks if c[0] == MARK and c != MARK]
            exact = self.reference.encode([c[1:].replace(MARK, " ") for c in known])
            self.wrong.update(c for c, ids in zip(known, exact) if np.array(ids, dtype="<i4").tobytes() != found[c])
        return found

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of distinct chunks. Words with one marker in front are encoded
        TOGETHER to a string: no piece crosses a marker, so a word's ids begin
        where a piece with a marker does."""
        words, rest = [], []
        for c in new:
            (words if self.splits and len(c) > 1 and c.rfind(MARK) == 0 and " " not in c else rest).append(c)
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        coded = [np.array(e.ids, dtype="<i4") for e in self.chunk.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)]
        exact = [None] * len(groups)
        if self.reference is not None and self.plain:
            exact = self.reference.encode([" ".join(c[1:] for c in g) for g in groups], num_threads=THREADS)
        found: dict[str, bytes] = {}
        for group, ids, known in zip(groups, coded, exact):
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) != len(group) or known is not None and not np.array_equal(ids, known):
                rest += group
                continue
            data, cuts = ids.tobytes(), [*(starts * 4).tolist(), ids.nbytes]
            found.update(zip(group, map(data.__getitem__, map(slice, cuts, cuts[1:]))))
        return found | self._each(rest) if rest else found

    def _ids_of(self, distinct: set[str]) -> dict[str, bytes]:
        """Looks chunks up, and learns the rest. What a worker remembers has
        two generations: what the older holds moves on when it is used."""
        every, moved, new = {}, {}, []
        known, older = self.known, self.older
        for c in distinct:
            if (ids := known.get(c)) is None:
                if (ids := older.get(c)) is None:
                    new.append(c)
                    continue
                moved[c] = ids
            every[c] = ids
        for at in range(0, len(new), 20_000):
            learnt = self._learn(new[at : at + 20_000])
            every |= learnt
            moved |= {c: ids for c, ids in learnt.items() if len(c) <= LONG_CHUNK}
        if self.held > REMEMBERED:
            self.known, self.older, self.held = {}, self.known, 0
        self.known |= moved
        self.held += sum(map(len, moved)) + sum(map(len, moved.values())) + ENTRY * len(moved)
        return every

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text, and whether the sentencepiece library has the same."""
        cut = [self.chunks(t or "") for t in texts]
        ids_of = self._ids_of(set(chain.from_iterable(cut))).__getitem__
        ids = [np.frombuffer(b"".join(map(ids_of, cs)), dtype="<i4") for cs in cut]
        agree = [True] * len(cut) if not self.wrong else [self.wrong.isdisjoint(cs) for cs in cut]
        if self.reference is not None and not self.plain:
            agree = [np.array_equal(a, b) for a, b in zip(self.reference.encode([t or "" for t in texts]), ids)]
        return ids, agree

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The pieces' bytes, joined; texts whose bytes are no UTF-8 go through
        the library's decoder, which marks each stray byte."""
        flat = np.concatenate([*ids, np.zeros(0, dtype="<i4")])
        size = self.sizes[flat]
        ends = np.cumsum(size)
        # Byte i of a piece that ends at `end` is byte size - (end - i) of its place in the table.
        data = self.table[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.places[flat] + size - ends, size)].tobytes()
        edges = np.append(0, ends)[np.cumsum([0, *map(len, ids)])].tolist()
        out = []
        for i, a, b in zip(ids, edges, edges[1:]):
            try:
                out.append(data[a + (self.model.dummy_prefix and data[a : min(a + 1, b)] == b" ") : b].decode("utf-8"))
            except UnicodeDecodeError:
                out.append(self.whole.decode(i.tolist(), skip_special_tokens=False))
        return out


@cache
def codec(path: str, check: bool) -> Codec:
    """One a worker process and model file."""
    task = TaskContext.get()
    os.environ.setdefault("RAYON_NUM_THREADS", str(max(THREADS, task.cpus() if task else 1)))  # read when the library starts
    with open(path, "rb") as f:
        return Codec(f.read(), check)


def encode(docs: DataFrame, model_path: str, check: bool = True) -> DataFrame:
    """doc_id, ids, agree, round_trip, decoded_sha256. `model_path`: a file
    that every executor has, as with an installed package."""
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, check)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                texts = [t.as_py() for t in part.column(1)]
                ids, agree = own.encode(texts)
                back = own.decode(ids)
                same = [b == (t or "") for b, t in zip(back, texts)]
                flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                digests = [sha256(b.encode("utf-8", "surrogatepass")).hexdigest() for b in back]
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(agree), pa.array(same), pa.array(digests)], ["doc_id", "ids", "agree", "round_trip", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(lean(run), "doc_id bigint, ids array<int>, agree boolean, round_trip boolean, decoded_sha256 string")


def lengths(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, tokens: encoded lengths alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, False)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                found = [len(i) for i in own.encode([t.as_py() for t in part.column(1)])[0]]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int64())], ["doc_id", "tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(lean(run), "doc_id bigint, tokens bigint")
