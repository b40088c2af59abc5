"""Fill-in-the-middle transformation: cut points found by rank queries on a wavelet matrix over character classes.

A unit is a run of ASCII letters or any other single character. Each character falls into one of three classes: other, a
letter that begins a run, a letter within a run. The texts of a batch are one sequence of classes, held as a wavelet
matrix of two bit levels whose 64-bit words carry running counts, so a rank costs a few look-ups. The number of units that
begin before a place is ``rank(other) + rank(first letter)``; the place at which a unit ends is found by bisection on
that count, for all cuts of the batch at once. No unit is ever written out.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starsift.llm.shared import per_batch, runs

U = np.uint64
OTHER, FIRST, WITHIN = 0, 1, 2
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20
#: Put before the decimal id when it is hashed.
SALT = "1:"


class Bits:
    """A bit sequence with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, U)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.cumsum(np.r_[0, np.bitwise_count(self.words[:-1])], dtype=np.int64)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before place ``i``."""
        word, rest = i >> 6, (i & 63).astype(U)
        return self.before[word] + np.bitwise_count(self.words[word] & ((U(1) << rest) - U(1)))


class WaveletMatrix:
    """Symbols below ``2**levels``: each level sorts the sequence stably by its bit, highest bit first."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels = []
        for level in reversed(range(levels)):
            bits = (symbols >> level) & 1
            self.levels.append((level, Bits(bits), len(bits) - int(bits.sum())))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before place ``i``."""
        lo, hi = np.zeros_like(i), i
        for level, bits, zeros in self.levels:
            if symbol >> level & 1:
                lo, hi = zeros + bits.ones(lo), zeros + bits.ones(hi)
            else:
                lo, hi = lo - bits.ones(lo), hi - bits.ones(hi)
        return hi - lo


def classes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of each code point; no run of letters goes on over a text's start."""
    lower = points | 32
    letter = (lower >= 97) & (lower <= 122) & (points < 128)
    follows = np.r_[False, letter[:-1]]
    follows[starts[starts < len(points)]] = False
    return np.where(letter, np.where(follows, WITHIN, FIRST), OTHER).astype(np.uint8)


class Units:
    """Unit counts and unit ends of many texts that stand one after another."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.ends = np.cumsum([len(t) for t in texts])
        self.starts = self.ends - [len(t) for t in texts]
        self.matrix = WaveletMatrix(classes(points, self.starts), 2)
        self.base = self.begun(self.starts)
        self.counts = self.begun(self.ends) - self.base

    def begun(self, place: np.ndarray) -> np.ndarray:
        """Units that begin before ``place``."""
        return self.matrix.rank(OTHER, place) + self.matrix.rank(FIRST, place)

    def end_of(self, unit: np.ndarray) -> np.ndarray:
        """For each text the number of characters in its first ``unit`` units: the last place with so many begun."""
        lo, hi = self.starts.copy(), self.ends.copy()
        while (lo < hi).any():
            middle = (lo + hi + 1) >> 1
            fits = self.begun(middle) - self.base <= unit
            lo, hi = np.where(fits, middle, lo), np.where(fits, hi, middle - 1)
        return lo - self.starts


def draws(key: int | None, salt: str = SALT) -> list[int]:
    """Four unsigned 32-bit numbers from the id; a null id hashes as the salt alone."""
    digest = hashlib.sha256(f"{salt}{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def arrange(text: str, form: str, a: int, b: int, marks: tuple[str, str, str] = MARKS) -> str:
    p, s, m = marks
    if form == "plain":
        return text
    return f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}" if form == "psm" else f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"


def restore(output: str, form: str, marks: tuple[str, str, str] = MARKS) -> str:
    """The text of an output; marks stand in it only where ``arrange`` put them."""
    p, s, m = marks
    if form == "plain":
        return output
    first, second = (p, s) if form == "psm" else (s, p)
    one, rest = output[len(first) :].split(second, 1)
    two, middle = rest.split(m, 1)
    return one + middle + two if form == "psm" else two + middle + one


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks: tuple[str, str, str] = MARKS,
    plain_percent: int = PLAIN_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT, salt: str = SALT, keep: bool = True,
) -> DataFrame:
    """id_col, n (units), form, prefix_chars, middle_chars, output_sha256, restored_sha256 and, with ``keep``, output.

    Cuts and form follow from the id alone, so they repeat under any partitioning. A null text counts as empty; empty texts
    and texts that hold a mark stay plain, with null cuts. A null id has its own fixed draws; repeated rows are transformed
    one by one; other columns are not read. An empty table gives no rows. Texts are whole and never cross a row; memory
    follows the longest text or a run of ``shared.RUN_CHARS`` characters.
    """

    def work(batch: pa.RecordBatch):
        keys, every = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        for lo, hi in runs(every):
            ids, texts = keys[lo:hi], every[lo:hi]
            units = Units(texts)
            h = np.array([draws(k, salt) for k in ids], np.int64).reshape(-1, 4)
            cuts = np.sort(h[:, :2] % (units.counts[:, None] + 1), axis=1)
            a, b = units.end_of(cuts[:, 0]).tolist(), units.end_of(cuts[:, 1]).tolist()
            stays = (h[:, 2] % 100 >= 100 - plain_percent).tolist()
            other = np.where(h[:, 3] % 100 < suffix_first_percent, "spm", "psm").tolist()
            forms = ["plain" if s or not t or any(m in t for m in marks) else f for s, t, f in zip(stays, texts, other)]
            cut = [f != "plain" for f in forms]
            outputs = [arrange(t, f, x, y, marks) for t, f, x, y in zip(texts, forms, a, b)]
            sha = [hashlib.sha256(o.encode("utf-8", "surrogatepass")).hexdigest() for o in outputs]
            back = [hashlib.sha256(restore(o, f, marks).encode("utf-8", "surrogatepass")).hexdigest() for o, f in zip(outputs, forms)]
            columns = [
                batch.column(0).slice(lo, hi - lo), pa.array(units.counts, pa.int64()), pa.array(forms),
                pa.array([x if c else None for x, c in zip(a, cut)], pa.int64()), pa.array([y - x if c else None for x, y, c in zip(a, b, cut)], pa.int64()),
                pa.array(sha), pa.array(back),
            ]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(outputs)] * keep, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    schema += ", output string" * keep
    names = [c.split()[0] for c in schema.split(", ")]
    return per_batch(docs.select(id_col, text_col), work, schema)
