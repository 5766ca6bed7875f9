"""SentencePiece encoding and decoding by a merge-type prefix table.

Every prefix of a text has one last token: the token that ends the encoding of
that prefix.  One Aho-Corasick pass over the text names the pieces that end at
each position; a piece is the last token there exactly if it is compatible with
the last token before it, that is, if merging the two side by side leaves both
whole.  So the table holds one token a position, is filled from left to right,
and the ids are read from it backwards.

Compatibility of two pieces follows from how each is merged by itself: while
both grow, the symbols that touch across the border are compared with the
vocabulary, and a merge across it that comes before the next merge of either
side breaks the pair.  Pieces merged out of the order of their scores (runs of
white space, which share one score) are tested by merging the pair itself.

Where no piece of the model has white space after another character, texts are
encoded in units of white space plus what follows; frequent units are kept in a
bounded table.  A character that the model lacks becomes the ids of its bytes.

Rows are only mapped, whole texts of any length in time linear in their length.
Null and empty texts have no ids but the end id and decode to the empty string;
null ids decode to the empty string; repeated rows are each encoded; there are
no ties, an encoding is unique; an empty table gives an empty table.  Only the
columns named in ``keep`` are carried and none of them may be called ``ids`` or
``decoded``; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
import string
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import map_batches, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
NEVER = 1 << 60
MAX_UNITS, MAX_PAIRS, UNIT_CHARS = 100_000, 200_000, 48
SLICE = 500  # rows that are turned at once
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceModel:
    """A merge-type (BPE) SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb2

        with open(path, "rb") as file:
            proto = pb2.ModelProto.FromString(file.read())
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if spec.model_type != pb2.TrainerSpec.BPE or not spec.byte_fallback:
            raise ValueError("only merge-type models with byte fallback are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with identity normalisation are supported")
        if spec.treat_whitespace_as_suffix or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined or unused pieces and suffix white space are not supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.end_id = spec.eos_id
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        scores = sorted({p.score for p in proto.pieces if p.type == NORMAL}, reverse=True)
        order = {s: k for k, s in enumerate(scores)}
        self.rank = {p.piece: order[p.score] for p in proto.pieces if p.type == NORMAL}
        ranks = list(self.rank.values())
        self.shared = {r for r, n in zip(*np.unique(ranks, return_counts=True), strict=True) if n > 1}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1:  # with the compatibility of the tokens before it, as far as known
                self.automaton.add_word(piece, (piece, len(piece), {}))
        self.automaton.make_automaton()
        self.n_pairs = 0
        self.units = self._unit_pattern()
        self._spines: dict[str, tuple | None] = {}
        self._known: dict[str, tuple[int, ...]] = {}
        # decoding: surface of every id; None for bytes that need their neighbours
        raw = {i: b for b, i in self.bytes.items()}
        self.first = [p.piece for p in proto.pieces]
        self.surface: list[str | None] = []
        for i, p in enumerate(proto.pieces):
            if i in raw:
                self.surface.append(chr(raw[i]) if raw[i] < 128 else None)
            elif p.type == UNKNOWN:
                self.surface.append(spec.unk_surface)
            else:
                self.surface.append("" if p.type == CONTROL else p.piece.replace(SPACE, " "))
        self.raw, self.silent = raw, {i for i, p in enumerate(proto.pieces) if p.type == CONTROL}

    def _unit_pattern(self) -> re.Pattern:
        """Cuts a text where no piece reaches across: before white space that
        follows another character, around line breaks and digits, and between
        letters and ASCII punctuation; as far as that holds for the model."""
        pairs = {a + b for p in self.ids for a, b in pairwise(p)}
        alone = "".join(c for c in "0123456789\n" if not any(c in pair for pair in pairs))
        single = f"[{alone}]|" if alone else ""
        if any(a != SPACE and b == SPACE for a, b in pairs):
            return re.compile(f"{single}[^{alone}]+" if alone else "(?s:.+)")
        rest = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        bound = {x for a, b in pairs for x, y in ((a, b), (b, a)) if y in string.punctuation}
        kept_out = "".join(re.escape(c) for c in sorted(bound) if c.isalnum() and c not in alone)
        letter, marks = rf"[^\W\d_{kept_out}]", "".join(map(re.escape, string.punctuation))
        whole_word = rf"{SPACE}*+{letter}++(?=[{marks}{SPACE}{alone}]|\Z)"
        whole_mark = rf"{SPACE}*+[{marks}]++(?={letter}|[{SPACE}{alone}]|\Z)"
        return re.compile(f"{single}{whole_word}|{whole_mark}|{rest}")

    def merged(self, text: str) -> tuple[list[str], list[tuple[int, str, str]]]:
        """Symbols of ``text`` after all merges (best score first, leftmost of
        equals), and the merges (rank, left, right) in order.  For short texts."""
        parts, steps = list(text), []
        while True:
            ranked = [(r, i) for i, (a, b) in enumerate(pairwise(parts)) if (r := self.rank.get(a + b)) is not None]
            if not ranked:
                return parts, steps
            r, i = min(ranked)
            steps.append((r, i, len(parts) - 2 - i))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def spines(self, piece: str) -> tuple | None:
        """What stands at the left and at the right edge of ``piece`` while it
        is merged: (symbol, rank of the merge that replaces it) each; whether
        its merges come in the order of their ranks.  None if merging its
        characters does not lead to it."""
        if piece not in self._spines:
            parts, steps = self.merged(piece)
            found = None
            if parts == [piece]:
                size = list(map(len, piece))
                left, right, a, b = [], [], 1, 1
                for r, i, after in steps:
                    if i == 0:
                        left.append((piece[:a], r))
                        a += size[1]
                    if after == 0:
                        right.append((piece[len(piece) - b :], r))
                        b += size[-2]
                    size[i : i + 2] = [size[i] + size[i + 1]]
                ranks = [r for r, _, _ in steps]
                plain = ranks == sorted(ranks) and self.shared.isdisjoint(ranks)
                found = [*left, (piece, NEVER)], [*right, (piece, NEVER)], plain
            self._spines[piece] = found
        return self._spines[piece]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging ``a`` (may be empty) followed by ``b`` gives just these."""
        if not a:
            return self.spines(b) is not None
        one, two = self.spines(a), self.spines(b)
        if one is None or two is None:
            return False
        if not (one[2] and two[2]):
            return self.merged(a + b)[0] == [a, b]
        left, right, i, j = one[1], two[0], 0, 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            r = self.rank.get(x + y)
            if r is not None and r < x_ends and r <= y_ends:
                return False
            if x_ends == y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def last_tokens(self, unit: str) -> list[str]:
        """The last token of every prefix of ``unit`` (entry 0 is unused).

        Where no longer piece fits, it is the last character."""
        last, done = ["", *unit], -1
        for end, (piece, size, after) in self.automaton.iter(unit):
            if end == done:
                continue
            before = last[end + 1 - size]
            good = after.get(before)
            if good is None:
                self.n_pairs += 1
                if self.n_pairs > MAX_PAIRS:
                    self._forget()
                good = after[before] = self.compatible(before, piece)
            if good:
                last[end + 1] = piece
                done = end
        return last

    def _forget(self) -> None:
        for _, _, after in self.automaton.values():
            after.clear()
        self.n_pairs = 0

    def _unit(self, unit: str) -> tuple[int, ...]:
        last, at, out, ids = self.last_tokens(unit), len(unit), [], self.ids
        while at:
            token = last[at]
            number = ids.get(token)
            if number is None:
                out.extend(self.bytes[b] for b in reversed(token.encode()))
            else:
                out.append(number)
            at -= len(token)
        out.reverse()
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text``, without an end id."""
        out: list[int] = []
        if not text:
            return out
        text = self.prefix + text.replace(" ", SPACE)
        known = self._known
        for unit in self.units.findall(text):
            ids = known.get(unit)
            if ids is None:
                ids = self._unit(unit)
                if len(unit) <= UNIT_CHARS:
                    if len(known) >= MAX_UNITS:
                        known.clear()
                    known[unit] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no character each give U+FFFD."""
        out = [self.surface[i] for i in ids]
        if None in out:
            self._characters(ids, out)
        if self.prefix:
            for k, i in enumerate(ids):
                if i not in self.silent:
                    if i not in self.raw and self.first[i].startswith(SPACE):
                        out[k] = out[k][1:]
                    break
        return "".join(out)

    def _characters(self, ids: list[int], out: list[str | None]) -> None:
        k = 0
        while k < len(out):
            if out[k] is not None:
                k += 1
                continue
            lead = self.raw[ids[k]]
            size = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
            tail = ids[k : k + size]
            value = bytes(self.raw[i] for i in tail if i in self.raw)
            try:
                out[k] = value.decode() if len(value) == size else "�"
            except UnicodeDecodeError:
                out[k] = "�"
            if len(out[k]) == 1 and out[k] != "�" or value == b"\xef\xbf\xbd":
                out[k + 1 : k + size] = [""] * (size - 1)
                k += size
            else:
                k += 1


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    """The model of a file, once a Python worker."""
    return PieceModel(path)


def encode(
    docs: DataFrame, *, model: str | None = None, end_id: bool = True, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` and ``ids`` (array<int>) of every row's ``text``; ``model`` is
    the file of the model."""
    path = model or model_path()
    schema = StructType(
        [*(docs.schema[c] for c in keep), StructField("ids", ArrayType(IntegerType(), False), False)]
    )

    def make():
        codec = load(path)
        tail = [codec.end_id] if end_id else []

        def step(whole):
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                ids, ends = [], [0]
                for text in batch.column("text"):
                    ids.append(np.array(codec.encode(text.as_py()) + tail, dtype=np.int32))
                    ends.append(ends[-1] + len(ids[-1]))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                yield {c: batch.column(c) for c in keep} | {"ids": lists}

        return step

    return map_batches(docs.select(*dict.fromkeys((*keep, "text"))), make, schema)


def decode(df: DataFrame, *, model: str | None = None) -> DataFrame:
    """``df`` (with ``ids``) and ``decoded``, the text of the ids."""
    path = model or model_path()
    schema = StructType([*df.schema.fields, StructField("decoded", StringType())])

    def make():
        codec = load(path)

        def step(whole):
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                column = batch.column("ids")
                flat = column.values.to_numpy(zero_copy_only=False)
                ends, gone = column.offsets.to_pylist(), column.is_null().to_pylist()
                texts = [
                    "" if none else codec.decode(flat[a:b].tolist())
                    for (a, b), none in zip(pairwise(ends), gone, strict=True)
                ]
                yield dict(zip(batch.schema.names, batch.columns, strict=True)) | {"decoded": texts}

        return step

    return map_batches(df, make, schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decode(encode(table(spark, sf_dir, "documents")))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op11_sentencepiece": op11}
