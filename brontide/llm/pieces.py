"""SentencePiece encoding and decoding by streaming Viterbi.

Normalised text is fed to one stream. For every boundary the best path's last piece is kept; a
path may go on only with pieces of at most the longest piece's length, so only boundaries in
that window survive. As soon as the backpointers of all survivors lead to one boundary, the ids
before it are committed and forgotten.

At some boundaries all paths meet whatever is around: before a space mark, around a line end
that no piece has, between a letter and a mark that no piece has side by side. Between two of
them lies a part, which always gets the same ids; a worker remembers those of short parts, and
every part that it does not remember goes through the stream.

Two kinds of model are read. Unigram: a path's worth is the sum of its scores. BPE: a sequence
of pieces is the model's encoding exactly if each neighbouring pair is the encoding of its own
concatenation, so a path may take a piece only after one that agrees with it; then each boundary
has one path, and ids equal those that merging gives. Unknown characters become bytes where the
model has them.

Defined results: a null text has null ids; an empty text has none; decoding null gives null;
ids without a piece fail; repeated rows get equal ids; an empty table gives no rows; result
columns replace input columns of the same name, and no other names are used. A very long text
needs memory for its normalised form and its ids, and the stream for paths that have not met.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brontide.llm.common import release

#: Parts and pairs of pieces that a worker process remembers, from task to task. Parts have two
#: generations: when the young one is full it becomes the old one, and what is met again comes
#: back young.
MEMO_WORDS = 150_000
MEMO_PAIRS = 200_000
MEMO_CHARS = 32
SPACE = "▁"
#: Rows that are encoded or decoded at once.
ROWS = 256
#: Characters that the stream takes before it looks for paths that have met.
CHUNK = 64
#: Stands before the first piece of a run; larger than any id.
_START = (1 << 20) - 1


class Vocabulary:
    """What encoding needs of a model file: pieces, scores and the library's normaliser."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = len(self.library)
        lib = self.library
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i) for i in range(size)]
        self.pieces = [lib.id_to_piece(i) for i in range(size)]
        self.special = special
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.scores = [lib.get_score(i) for i in range(size)]
        self.unknown = lib.unk_id()
        byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(size) if lib.is_byte(i)}
        self.byte_ids = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        self.bytes = {i: b for b, i in byte_ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        self.chars = {c for p in self.ids for c in p}
        # Merge models number their pieces by rank: whole negative scores, in order.
        normal = [s for i, s in enumerate(self.scores) if not special[i] and len(self.pieces[i]) > 1 and self.pieces[i].strip(SPACE)]
        self.merges = bool(normal) and all(s == int(s) for s in normal) and normal == sorted(normal, reverse=True)
        inside = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        #: Where paths always meet: before a space mark behind other characters, around a line
        #: end that no piece has, and between a letter and a mark that no piece has side by side.
        #: Cutting there only saves time.
        line = "" if "\n" in self.chars else "\n"
        side_by_side = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        letters = "".join(sorted(x for x in map(chr, range(0x41, 0x250)) if x.isalpha() and (x.isascii() or x in self.chars)))
        marks = "".join(re.escape(m) for m in "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~" if not any(x + m in side_by_side for x in letters))
        word = f"{SPACE}*[{letters}]+(?=[{marks}])|" if marks else ""
        self.cut = None if inside else re.compile(f"{word}{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + (f"|{line}" if line else ""))

        self.index()

    def index(self) -> None:
        """The automaton that finds all pieces ending at each character, with id and length, and
        the pattern of runs of known characters and single unknown ones."""
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        known = "".join(re.escape(c) for c in sorted(c for c in self.chars if c in self.ids))
        self.runs = re.compile(f"[{known}]+|(?s:.)" if known else "(?s:.)")

    def normalised(self, text: str) -> str:
        return self.library.normalize(text)


class Viterbi:
    """Encodes one stream of normalised text; holds only what is not committed."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pairs: dict[int, bool] = {}
        self.made: dict[int, tuple[int, int] | None] = {}
        self.is_whole: dict[int, bool] = {}

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Plain merging of a short text: the best-scored neighbours first, leftmost of equals,
        until `least` parts are left or nothing merges."""
        parts, ids, scores = list(text), self.v.ids, self.v.scores
        while len(parts) > least:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and scores[i] > best:
                    best, at = scores[i], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes a piece; none for a character, or for a piece that
        merging never makes, which is its own end."""
        known = self.made.get(piece, False)
        if known is False:
            parts = self.merged(self.v.pieces[piece], 2)
            ids = [self.v.ids.get(x) for x in parts]
            known = self.made[piece] = tuple(ids) if len(ids) == 2 and None not in ids else None
        return known

    def whole(self, piece: int) -> bool:
        """Whether merging its characters gives the piece."""
        text = self.v.pieces[piece]
        known = self.is_whole.get(piece)
        if known is None:
            known = self.is_whole[piece] = self.merged(text) == [text]
        return known

    def agree(self, key: int) -> bool:
        """Whether merging keeps a piece whole behind another; key holds both ids. Both are
        taken apart from the border on, the later merge first: while both are whole, no pair
        across the border may have merged before the parts that it takes were merged away."""
        if len(self.pairs) > MEMO_PAIRS:
            self.pairs.clear()
        a, b = key >> 20, key & _START
        known = self.whole(b) and (a == _START or self.whole(a) and self._apart(a, b))
        self.pairs[key] = known
        return known

    def _apart(self, a: int, b: int) -> bool:
        scores, ids, pieces = self.v.scores, self.v.ids, self.v.pieces
        # The merge just taken back; a pair across that merges before it parts what it made. Of
        # equal merges the left one comes first.
        limit, strict = -np.inf, False
        while True:
            across = ids.get(pieces[a] + pieces[b])
            if across is not None and (scores[across] > limit or not strict and scores[across] == limit):
                return False
            left, right = self.halves(a), self.halves(b)
            if left is None and right is None:
                return True
            # Of the two, the one that was merged last is taken apart; of equals the right one.
            if right is None or left is not None and scores[a] < scores[b]:
                limit, strict, a = scores[a], True, left[1]
            else:
                limit, strict, b = scores[b], False, right[0]

    def encode(self, chunks: Iterable[str]) -> Iterator[int]:
        """Ids of a text that comes in chunks, in parts as paths meet."""
        stream, unknown = None, False
        for chunk in chunks:
            for run in self.v.runs.findall(chunk):
                if run in self.v.ids or len(run) > 1:
                    stream, unknown = stream or _Stream(self), False
                    yield from stream.feed(run)
                    continue
                if stream:
                    yield from stream.finish()
                    stream = None
                if self.v.byte_ids:
                    yield from (self.v.byte_ids[x] for x in run.encode("utf-8", "replace"))
                elif not unknown:
                    yield self.v.unknown
                unknown = True
        if stream:
            yield from stream.finish()

    def part(self, text: str) -> list[int]:
        """The ids of a whole part."""
        runs = self.v.runs.findall(text)
        if len(runs) == 1 and (len(text) > 1 or text in self.v.ids):
            stream = _Stream(self)
            return stream.feed(text) + stream.finish()
        return list(self.encode((text,)))


class _Stream:
    """A run of known characters on its way. Lists start at the last commit: for each boundary
    behind it the last piece of its path, where that piece starts, and the path's worth."""

    def __init__(self, viterbi: Viterbi):
        self.viterbi, self.v = viterbi, viterbi.v
        self.scan = self.v.automaton.iter("")
        self.base = 0
        self.last: list[int | None] = [_START]
        self.back = [0]
        self.worth = [0.0]

    def feed(self, run: str) -> list[int]:
        """Takes more characters; gives the ids that are committed by then."""
        out: list[int] = []
        for k in range(0, len(run), CHUNK):
            self._feed(run[k : k + CHUNK])
            if len(self.last) > 2 * self.v.longest:
                out += self.commit()
        return out

    def _feed(self, run: str) -> None:
        self.scan.set(run)
        last, back, worth, pairs, agree = self.last, self.back, self.worth, self.viterbi.pairs, self.viterbi.agree
        more, base = len(run), self.base - 1
        last += [None] * more
        back += [0] * more
        if not self.v.merges:
            worth += [0.0] * more
            scores = self.v.scores
            for at, (piece, size) in self.scan:
                at -= base
                start = at - size
                if start < 0 or last[start] is None:
                    continue
                value = worth[start] + scores[piece]
                if last[at] is None or value > worth[at]:
                    last[at], back[at], worth[at] = piece, start, value
            return
        get = pairs.get
        for at, (piece, size) in self.scan:
            at -= base
            # Pieces come by their end, the longest first; the first that agrees is the path's.
            if last[at] is None and (start := at - size) >= 0 and (before := last[start]) is not None:
                known = get(key := before << 20 | piece)
                if known or known is None and agree(key):
                    last[at], back[at] = piece, start

    def commit(self) -> list[int]:
        """Ids before the boundary where the paths of all boundaries in the window meet."""
        first = max(0, len(self.last) - self.v.longest)
        alive = {b for b in range(first, len(self.last)) if self.last[b] is not None}
        while len(alive) > 1:
            latest = max(alive)
            alive.remove(latest)
            alive.add(self.back[latest])
            if 0 in alive:
                return []
        met = alive.pop() if alive else 0
        out = self.path(met)
        self.last, self.worth = self.last[met:], self.worth[met:]
        self.back = [max(0, b - met) for b in self.back[met:]]
        self.base += met
        return out

    def path(self, at: int) -> list[int]:
        out = []
        while at:
            out.append(self.last[at])
            at = self.back[at]
        out.reverse()
        return out

    def finish(self) -> list[int]:
        return self.path(len(self.last) - 1)


class Encoder:
    """Whole texts to ids, with the ids of short words remembered."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.viterbi = Viterbi(self.v)

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit integers in a row."""
        normal = self.v.normalised(text)
        if self.v.cut is None or (not self.v.merges and not self.v.byte_ids):
            return array("i", self.viterbi.encode((normal,))).tobytes()
        young, out = self.young, []
        for w in self.v.cut.findall(normal):
            ids = young.get(w)
            if ids is None:
                ids = self.old.get(w) or self._new(w)
                if len(w) <= MEMO_CHARS:
                    if len(young) >= MEMO_WORDS:
                        self.old, self.young = young, {}
                        young = self.young
                    young[w] = ids
            out.append(ids)
        return b"".join(out)

    def _new(self, part: str) -> bytes:
        return array("i", self.viterbi.part(part)).tobytes()

    def forget(self) -> None:
        self.young, self.old = {}, {}
        self.viterbi.pairs.clear()


class Decoder:
    """Ids to text."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.raw: dict[int, int] = {}
        #: What each id stands for by itself; None for bytes that are no character alone.
        self.texts: list[str | None] = []
        for i in range(len(lib)):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.raw[i] = int(piece[3:5], 16)
                self.texts.append(chr(self.raw[i]) if self.raw[i] < 128 else None)
            else:
                self.texts.append(" ⁇ " if lib.is_unknown(i) else "" if lib.is_control(i) else piece.replace(SPACE, " "))

    def decode(self, ids: list[int]) -> str:
        texts = self.texts
        try:
            text = "".join([texts[i] for i in ids])
        except TypeError:
            text = self._with_bytes(ids)
        return text[1:] if text.startswith(" ") else text

    def _with_bytes(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            b = self.raw.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.texts[i])
        out.append(raw.decode("utf-8", "replace"))
        return "".join(out)


_ENCODERS: dict[str, Encoder] = {}
_DECODERS: dict[str, Decoder] = {}


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    keep = [i for i, f in enumerate(batch.schema.names) if f != name]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), column], [*(batch.schema.names[i] for i in keep), name])


def _schema(docs: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in docs.schema if f.name != name), T.StructField(name, kind)])


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with the ids of each text. model_path: a model file installed on every machine."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _ENCODERS.get(model_path) or _ENCODERS.setdefault(model_path, Encoder(model_path))
        for batch in _slices(batches):
            ids = [None if t is None else own.encode(t) for t in batch.column(text_col).to_pylist()]
            ends = np.cumsum([0] + [len(x or b"") // 4 for x in ids])
            values = pa.array(np.frombuffer(b"".join(x for x in ids if x), np.int32))
            mask = pa.array([x is None for x in ids])
            yield _with(batch, ids_col, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=mask))
        # What was learnt stays for the worker's next task; its size is bounded.
        release()

    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    return docs.mapInArrow(encoded, _schema(docs, ids_col, T.ArrayType(T.IntegerType())))


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """docs with the text of each array of ids."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _DECODERS.get(model_path) or _DECODERS.setdefault(model_path, Decoder(model_path))
        for batch in _slices(batches):
            texts = [None if x is None else own.decode(x) for x in (i.values.to_numpy().tolist() if i.is_valid else None for i in batch.column(ids_col))]
            yield _with(batch, text_col, pa.array(texts, pa.string()))
        release()

    return docs.mapInArrow(decoded, _schema(docs, text_col, T.StringType()))
