"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it stands for."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
CHUNK = 1 << 20      # characters of normalised text that are segmented at once, where pieces allow a cut
YIELD = 1 << 21      # characters of text whose rows leave a task together

# Fixed values of the model file's format: field numbers, piece types, wire types.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
UNKNOWN, USER_DEFINED, BYTE = 2, 4, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(number, value, whole encoding) of the fields of a message."""
    at = 0
    while at < len(data):
        start = at
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if tag & 7 == 2 else (4 if tag & 7 == 5 else 8, at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value, data[start:at]


def charmap(compiled: bytes) -> dict[str, str]:
    """The rules of a compiled character map: a little-endian size, a double array over the UTF-8 bytes of the
    sources, and the targets, each ended by a zero byte. A leaf's value is the place of its target."""
    if not compiled:
        return {}
    size = int.from_bytes(compiled[:4], "little")
    units, targets = np.frombuffer(compiled, dtype="<u4", count=size // 4, offset=4).astype(np.int64), compiled[4 + size:]
    labels = units & ((1 << 31) | 255)
    jump = (units >> 10) << ((units & (1 << 9)) >> 6)
    rules: dict[str, str] = {}
    every, open_nodes = np.arange(1, 256), [(int(jump[0]), b"")]
    while open_nodes:
        node, prefix = open_nodes.pop()
        places = node ^ every
        places = places[places < len(units)]
        for place in places[labels[places] == (node ^ places)].tolist():
            source, below = prefix + bytes([node ^ place]), place ^ int(jump[place])
            if units[place] >> 8 & 1:
                at = int(units[below] & ((1 << 31) - 1))
                rules[source.decode()] = targets[at:targets.index(b"\0", at)].decode()
            open_nodes.append((below, source))
    return rules


@dataclass
class Normalizer:
    """Rewrites a text by the longest rule at each place and tells the source byte behind every byte it writes."""

    rules: dict[str, str]
    symbols: tuple[str, ...] = ()        # user-defined ones, kept as they are
    add_prefix: bool = True
    squeeze: bool = True                 # white space at the ends goes, runs of it become one
    escape: bool = True
    prefix_last: bool = False

    @cached_property
    def _candidate(self) -> re.Pattern | None:
        """Where a rule or symbol may begin: characters with a rule of their own, and pairs that begin a longer one."""
        texts = [*self.rules, *self.symbols]
        one = {t for t in texts if len(t) == 1}
        seconds: dict[str, set[str]] = {}
        for t in texts:
            if len(t) > 1:
                seconds.setdefault(t[1], set()).add(t[0])
        firsts: dict[frozenset, set[str]] = {}
        for second, first in seconds.items():
            firsts.setdefault(frozenset(first), set()).add(second)
        chars = lambda cs: "[" + "".join(map(re.escape, sorted(cs))) + "]"
        parts = [chars(one)] * bool(one) + [f"{chars(f)}(?={chars(s)})" for f, s in firsts.items()]
        return re.compile("|".join(parts)) if parts else None

    @cached_property
    def _longest(self) -> int:
        return max(map(len, [*self.rules, *self.symbols]), default=0)

    @cached_property
    def _symbol(self) -> re.Pattern | None:
        return re.compile("|".join(map(re.escape, sorted(self.symbols, key=len, reverse=True)))) if self.symbols else None

    def _replaced(self, text: str) -> Iterator[tuple[int, int, str]]:
        """(from, to, new text) of every place that a rule rewrites, or that a symbol protects, in order."""
        at, pattern = 0, self._candidate
        while pattern and (found := pattern.search(text, at)):
            start = found.start()
            at = start + 1
            if self._symbol and (kept := self._symbol.match(text, start)):
                yield start, kept.end(), kept[0]
                at = kept.end()
                continue
            for n in range(min(self._longest, len(text) - start), 0, -1):
                if (new := self.rules.get(text[start:start + n])) is not None:
                    yield start, start + n, new
                    at = start + n
                    break

    def _mapped(self, text: str) -> tuple[bytes, np.ndarray, int]:
        """(text after all rules, source of its bytes and end, end of the white space that the source begins with)."""
        out, align, at, byte, lead, leading = [], [], 0, 0, 0, True
        for start, end, new in self._replaced(text):
            plain, new = text[at:start].encode(), new.encode()
            out += [plain, new]
            align += [np.arange(byte, byte + len(plain)), np.full(len(new), byte + len(plain))]
            at, byte = end, byte + len(plain) + len(text[start:end].encode())
            if leading:
                blank = len(plain) - len(plain.lstrip(b" "))
                leading = blank == len(plain) and new == b" "
                lead = byte if leading else lead + blank
        plain = text[at:].encode()
        if leading:
            lead += len(plain) - len(plain.lstrip(b" "))
        return b"".join([*out, plain]), np.concatenate([*align, np.arange(byte, byte + len(plain) + 1)]), lead

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised text, source byte of each of its bytes and of its end). A rewritten stretch belongs to the
        first byte of its source as a whole; the prefix to the byte after the white space that it takes the place of."""
        data, align, lead = self._mapped(text)
        if self.squeeze and not data.strip(b" "):
            blank = lead == align[-1]
            return b"", np.array([0]) if blank else align[-1:] if self.prefix_last or not self.add_prefix else np.array([lead])
        if self.squeeze:
            space = np.frombuffer(data, dtype=np.uint8) == 32
            keep = ~(space & np.concatenate([[True], space[:-1]]))
            last = len(data) - len(data.rstrip(b" "))
            keep[len(data) - last:] = False
            end = align[len(data) - last] if last else align[-1]
            data, align = bytes(np.frombuffer(data, dtype=np.uint8)[keep]), np.append(align[:-1][keep], end)
        if not text:
            return b"", align
        if self.add_prefix:
            data, align = (data + b" ", np.append(align, align[-1])) if self.prefix_last else (b" " + data, np.append(lead * self.squeeze, align))
        if self.escape:
            wide = np.append(np.where(np.frombuffer(data, dtype=np.uint8) == 32, len(SPACE.encode()), 1), 1)
            data, align = data.replace(b" ", SPACE.encode()), np.repeat(align, wide)
        return data, align


class Encoder:
    """A model file: its own normalisation here, its segmentation by the library on text already normalised."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        with open(path, "rb") as f:
            model = f.read()
        pieces, trainer, spec, rest = [], {}, {}, []
        for number, value, raw in _fields(model):
            if number == NORMALIZER:
                spec = {n: v for n, v, _ in _fields(value)}
                continue
            rest.append(raw)
            if number == PIECE:
                own = {n: v for n, v, _ in _fields(value)}
                pieces.append((own[1], own.get(3, 1)))
            elif number == TRAINER:
                trainer = {n: v for n, v, _ in _fields(value)}
        # An own copy of the model whose normalisation leaves every text as it is.
        plain = bytes([NORMALIZER << 3 | 2, 6, 3 << 3, 0, 4 << 3, 0, 5 << 3, 0])
        self.segment = sentencepiece.SentencePieceProcessor(model_proto=b"".join(rest) + plain)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        symbols = tuple(p.decode() for p, kind in pieces if kind == USER_DEFINED)
        self.normalizer = Normalizer(
            charmap(spec.get(2, b"")), symbols, bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)),
            bool(trainer.get(24, 0)))
        self.fallback = bool(trainer.get(35, 0))
        self.is_byte = np.array([kind == BYTE for _, kind in pieces])
        self.sizes = np.array([1 if kind == BYTE else len(p) for p, kind in pieces])
        words = [p.decode() for p, kind in pieces if kind not in (UNKNOWN, BYTE)]
        #: No piece goes on over a word's end, so the text may be cut there.
        self.cuttable = self.normalizer.escape and not symbols and not any(re.search(f"[^{SPACE}]{SPACE}", w) for w in words)

    def _chunks(self, text: str) -> Iterator[str]:
        at = 0
        while self.cuttable and len(text) - at > CHUNK:
            cut = re.compile(f"(?<=[^{SPACE}])(?={SPACE})").search(text, at + CHUNK)
            if not cut:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str, end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first source byte, byte after the last) of the pieces. Of a character that falls apart into byte
        pieces the last has the whole source; the others, the prefix and the end id have empty spans."""
        data, align = self.normalizer(text)
        whole, ids, sizes = data.decode(), [], []
        for chunk in self._chunks(whole):
            own = np.array(self.segment.encode(chunk), dtype=np.int64)
            ids.append(own)
            sizes.append(self.sizes[own] if self.fallback else np.array(
                [len(p.encode()) for p in self.segment.encode(chunk, out_type=str)], dtype=np.int64))
        ids, sizes = np.concatenate(ids), np.concatenate(sizes)
        stops = np.cumsum(sizes)
        if (stops[-1] if len(stops) else 0) != len(data):
            raise ValueError("the pieces do not make up the normalised text")
        starts = stops - sizes
        begin, until = align[starts], align[stops]
        if (split := np.nonzero(self.is_byte[ids])[0]).size:
            raw = np.append(np.frombuffer(data, dtype=np.uint8), 0)
            opens = (raw & 0xC0) != 0x80
            first = np.maximum.accumulate(np.where(opens, np.arange(len(raw)), 0))
            begin[split] = align[first[starts[split]]]
            until[split] = np.where(opens[stops[split]], align[stops[split]], begin[split])
        if end:
            ids, begin, until = np.append(ids, self.library.eos_id()), np.append(begin, align[-1]), np.append(until, align[-1])
        return ids, begin, until

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@cache
def encoder(path: str | None = None) -> Encoder:
    import public_tokenizers

    return Encoder(path or public_tokenizers.path("piece_bpe_32k.model"))


def encode(docs: DataFrame, model_path: str | None = None, end: bool = True, decoded: bool = True,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, ids (the end id last), starts and ends (byte spans in the original UTF-8 text of
    every piece), and what the ids decode to.

    Null and empty texts have the end id alone. Null and repeated ids are rows like others; an empty table gives an
    empty one; further columns are ignored. A text is normalised whole and segmented in chunks that end where no
    piece can go on, with the pieces that the whole text has. No row leaves its partition, so nothing is shuffled
    and a lost executor costs its own partitions."""

    def run(batches):
        coder, kind = encoder(model_path), None
        for batch in batches:
            texts, kind, out, held, rows = batch.column(1), batch.column(0), [], 0, []
            for row in range(len(texts)):
                text = texts[row].as_py() or ""
                ids, begin, until = coder.encode(text, end)
                out.append((ids, begin, until, coder.decode(ids.tolist()) if decoded else None))
                rows.append(row)
                held += len(text)
                if held >= YIELD or row == len(texts) - 1:
                    yield _batch(kind.take(pa.array(rows, pa.int64())), out)
                    out, held, rows = [], 0, []

    def _batch(keys, out):
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(o[0]) for o in out])]).astype(np.int32))
        cols = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([o[k] for o in out]).astype(t)))
                for k, t in ((0, np.int32), (1, np.int64), (2, np.int64))]
        return pa.RecordBatch.from_arrays([keys, *cols, pa.array([o[3] for o in out], pa.string())],
                                          names=[id_col, "ids", "starts", "ends", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, ids array<int>, starts array<bigint>, ends array<bigint>, decoded string")
