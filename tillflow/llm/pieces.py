"""SentencePiece encoding that keeps byte offsets, and decoding.

Normalisation walks the text by the model's compiled character map: at every
position the longest prefix found in the map (a double-array trie over UTF-8
bytes) is replaced by its entry, and a character outside the map stays. Each
normalised byte records the source byte it came from, so a piece, which covers
a run of normalised bytes, projects back to a span of original bytes. A user-defined
symbol of the model stays as it is. White space is then trimmed, collapsed and escaped,
and one is added in front (or behind), as the model's settings say. The pieces are those of the
normalised text: the library gets it with a normaliser that changes nothing. A model
with an empty map takes the same route with nothing to
replace, vectorised.

No piece of a BPE model that respects white space holds an escaped space behind
another character, and no piece holds a newline, so no merge crosses the start
of a run of spaces or a newline: the ids of a text are the ids of such segments
in a row. Segments recur, so each is encoded once per Python worker (bounded
cache) by the sentencepiece library, which also encodes whole texts where the
model breaks these rules.

Edge cases: null and empty texts have no ids and decode to the empty text.
Unknown characters fall back to byte pieces, where the model has them; each byte piece's span is the
byte's own. Elsewhere a run of unknown characters is one piece, which spans them. A
trimmed space belongs to no piece, a collapsed run to its first space. Repeated rows get equal results; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillflow.llm.runtime import ship

MAX_CACHED, MAX_SEGMENT = 500_000, 48
SPACE_MARK = "▁"
_MODELS: dict[str, Pieces] = {}


class CharMap:
    """A compiled character map: longest-prefix replacement with source alignment."""

    def __init__(self, blob: bytes):
        self.empty = not blob
        if self.empty:
            return
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.out = blob[4 + size:]

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """(bytes read, replacement) of the longest entry that starts at ``start``."""
        units, node, found = self.units, 0, None
        unit = units[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(start, len(data)):
            c = data[i]
            node ^= c
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != c:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                at = units[node] & 0x7FFFFFFF
                found = (i + 1 - start, self.out[at:self.out.index(b"\0", at)])
        return found

    def normalise(self, data: bytes, symbols: re.Pattern | None = None) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source offset of each and of the end); what ``symbols`` match stays."""
        if self.empty and symbols is None:
            return data, np.arange(len(data) + 1)
        out, source, i = [], [], 0
        while i < len(data):
            step, text, whole = self.step(data, i, symbols)
            out.append(text)
            source += [i] * len(text) if whole else range(i, i + step)
            i += step
        source.append(len(data))
        return b"".join(out), np.array(source, np.int64)

    def step(self, data: bytes, i: int, symbols: re.Pattern | None) -> tuple[int, bytes, bool]:
        """(bytes read, what they become, whether that has one source) at an offset: a symbol, an entry or a character."""
        if symbols is not None and (m := symbols.match(data, i)):
            return m.end() - i, m[0], True
        hit = None if self.empty else self.longest(data, i)
        if hit is not None:
            return *hit, True
        first = data[i]
        step = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return step, data[i:i + step], False


@dataclass
class Encoded:
    ids: np.ndarray      # int32
    begin: np.ndarray    # original byte span of each piece
    end: np.ndarray


class Pieces:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        model.ParseFromString(self.lib.serialized_model_proto())
        spec = model.normalizer_spec
        self.map = CharMap(bytes(spec.precompiled_charsmap))
        self.mark = SPACE_MARK if spec.escape_whitespaces else " "
        self.suffix = spec.add_dummy_prefix and model.trainer_spec.treat_whitespace_as_suffix
        self.dummy = spec.add_dummy_prefix and not self.suffix
        self.trim = spec.remove_extra_whitespaces
        own = sorted((p.piece.encode() for p in model.pieces if p.type == pb.ModelProto.SentencePiece.USER_DEFINED), key=lambda x: (-len(x), x))
        self.symbols = re.compile(b"|".join(map(re.escape, own))) if own else None
        self.unknown = self.lib.unk_id()
        surfaces = [p.piece for p in model.pieces]
        byte = [p.type == pb.ModelProto.SentencePiece.BYTE for p in model.pieces]
        control = [p.type == pb.ModelProto.SentencePiece.CONTROL for p in model.pieces]
        self.raw = [bytes([int(s[3:5], 16)]) if b else b"" if c else s.encode() for s, b, c in zip(surfaces, byte, control)]
        self.plain = [r.replace(SPACE_MARK.encode(), b" ") for r in self.raw]
        self.width = np.array([len(r) for r in self.raw], np.int64)
        self.text = [str(i) for i in range(len(surfaces))]
        self.separable = (
            model.trainer_spec.model_type == 2 and model.trainer_spec.byte_fallback and self.map.empty and self.dummy
            and spec.escape_whitespaces and not self.trim and len(surfaces) < 1 << 16
            and not own
            and not any("\n" in s or re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", s) for s, b in zip(surfaces, byte) if not b))
        self.cache: dict[str, bytes] = {}
        # the model on normalised text
        spec.Clear()
        spec.MergeFrom(pb.NormalizerSpec(name="identity", add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=False))
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())

    def _segment(self, seg: str) -> bytes:
        """Ids (unsigned 16-bit) of a segment: spaces and what follows, or a newline, or text behind one."""
        ids = self.lib.encode(seg[1:]) if seg[0] == " " and len(seg) > 1 else self.lib.encode("\n" + seg)[2:]
        got = np.array(ids, "<u2").tobytes()
        if len(seg) <= MAX_SEGMENT and len(self.cache) < MAX_CACHED:
            self.cache[seg] = got
        return got

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        if not self.separable or SPACE_MARK in text:
            return np.array(self.inner.encode(self.normalise(text)[0]), np.int64)
        segments = _SEGMENTS.findall(" " + text)
        found = list(map(self.cache.get, segments))
        if None in found:
            found = [x if x is not None else self.cache.get(s) or self._segment(s) for x, s in zip(found, segments)]
        return np.frombuffer(b"".join(found), "<u2").astype(np.int64)

    def _spaced(self, norm: bytes, source: np.ndarray) -> np.ndarray:
        """Which normalised bytes stay when spaces at the start, or behind a space, go; those inside one entry stay."""
        space = np.frombuffer(norm, np.uint8) == 0x20
        at = np.arange(len(norm))
        starts = space & ~np.concatenate([[False], space[:-1]])
        run = np.maximum.accumulate(np.where(starts, at, -1))
        inside = run > np.searchsorted(source[:-1], source[:-1], side="left")
        return ~(space & (run == 0) | space & ~starts & ~inside)

    def sources(self, text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Normalised bytes before escaping, without the added space; those of each escaped byte, added space included, and of the end."""
        data = text.encode()
        norm, source = self.map.normalise(data, self.symbols)
        first = 0
        if self.trim:
            while first < len(data):
                step, chunk, _ = self.map.step(data, first, self.symbols)
                if chunk != b" ":
                    break
                first += step
            stay = self._spaced(norm, source)
            norm, source = np.frombuffer(norm, np.uint8)[stay].tobytes(), np.append(source[:-1][stay], len(data))
        width = len(self.mark.encode())
        steps = np.where(np.frombuffer(norm, np.uint8) == 0x20, width, 1)
        lead = np.full(width if self.dummy else 0, first, np.int64)
        return norm, np.concatenate([lead, np.repeat(source[:-1], steps)]), source[-1:]

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The text that the model cuts into pieces, and the source offset of each of its bytes and of the end."""
        norm, source, end = self.sources(text)
        mark = self.mark.encode()
        out = (mark if self.dummy else b"") + norm.replace(b" ", mark)
        if self.trim:
            if text and not out.replace(mark, b""):
                return "", np.zeros(1, np.int64)
            while out.endswith(mark):
                out, source, end = out[:-len(mark)], source[:-len(mark)], source[-len(mark):][:1]
        if self.suffix and out:
            out, source = out + mark, np.concatenate([source, np.repeat(end, len(mark))])
        return out.decode(), np.concatenate([source, end])

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Original byte spans of the pieces ``ids`` of ``text``."""
        width = self.width[ids]
        if self.trim or self.suffix:
            norm, source = self.normalise(text)
        else:
            norm, *source = self.sources(text)
            source = np.concatenate(source)
        unknown = np.flatnonzero(ids == self.unknown)
        if len(unknown):
            found = self.inner.encode(self.normalise(text)[0], out_type=str)
            width[unknown] = [len(found[i].encode()) for i in unknown]
        stop = np.cumsum(width)
        return source[stop - width], source[stop]

    def encode(self, text: str) -> Encoded:
        ids = self.ids(text)
        if not len(ids):
            return Encoded(ids, ids, ids)
        return Encoded(ids, *self.spans(text, ids))

    def decode(self, ids: list[int]) -> str:
        """The library's decode: pieces joined, marks as spaces, the leading one dropped, byte pieces as UTF-8."""
        if not self.separable:
            return self.lib.decode(ids)
        out = b"".join(map(self.plain.__getitem__, ids))
        if self.dummy and out[:1] == b" ":
            out = out[1:]
        return out.decode("utf-8", "replace")


_SEGMENTS = re.compile(r" +[^ \n]*|\n|[^ \n]+")


def model(path: str) -> Pieces:
    """The model of a file, one per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids array<int>, begins array<int>, ends array<int>)``: pieces and their original byte spans."""
    ship(docs.sparkSession)

    def run(batches):
        m = model(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                enc = [m.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array([getattr(e, f).astype(np.int32) for e in enc], pa.list_(pa.int32()))
                                              for f in ("ids", "begin", "end")]], ["doc_id", "ids", "begins", "ends"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, ends array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``."""
    ship(encoded.sparkSession)

    def run(batches):
        m = model(path)
        for batch in batches:
            texts = [m.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """Encode, project and decode every text in one pass, keeping digests of what came out.

    ``(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32)``; the last is the crc32 of the piece spans
    (little-endian 32-bit begins, then ends).
    """
    ship(docs.sparkSession)

    def run(batches):
        m = model(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                rows = []
                for text in part.column("text").to_pylist():
                    e = m.encode(text or "")
                    ids = e.ids.tolist()
                    spans = e.begin.astype("<i4").tobytes() + e.end.astype("<i4").tobytes()
                    rows.append((len(ids), hashlib.sha256(",".join(map(m.text.__getitem__, ids)).encode()).hexdigest(),
                                 hashlib.sha256(m.decode(ids).encode()).hexdigest(), zlib.crc32(spans)))
                cols = list(zip(*rows)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                     pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")
