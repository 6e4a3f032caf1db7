"""Spelling variants: words one edit apart, found by Gram matrices of letter counts (op13).

Two words one edit apart have letter counts at a squared distance of 1 (a
letter more or less) or 2 (a letter replaced).  Words are therefore dealt
into cells by the counts of CLASSES letter classes, which also fix the
length.  An edit leads to the same cell, to a cell where one letter has
changed its class, or to a cell of the next length with a letter more in one
class: 1 + 7 * 6 / 2 + 7 cells when each pair of cells is taken once.  Cells
are cut into tiles of bounded size; tiles of neighbouring cells meet in a
join, and a task multiplies their count matrices:

    |x - y|^2 = |x|^2 + |y|^2 - 2 x.y

Pairs at a distance of at most two go on to an exact comparison of the
letters.  No pair of near words can fall outside of neighbouring cells, so
none is lost, and a frequent cell costs more tile pairs, not a larger task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanlytics.llm import common as C
from chanlytics.llm.words import slices

LEAST_LETTERS, LEAST_COUNT, SALT_DIVISOR, RATIO = 5, 3, 97, 2
#: Letter classes (code point mod CLASSES), words in a tile, words of a product's right side.
CLASSES, TILE, RIGHT = 7, 2048, 8192
#: Distinct words that a counting task holds before it passes them on.
HELD = 500_000
_RUN = rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}"

# letters as columns of the count matrix: a-z, then U+00C0 to U+00FF; words are Latin-1
_COLUMN = np.zeros(256, np.int64)
_COLUMN[0x61:0x7B] = range(26)
_COLUMN[0xC0:0x100] = range(26, 90)
_LETTERS = 90


def _counter(least: int):
    run = re.compile(_RUN % least)

    def count(batches):
        total: Counter = Counter()

        def out():
            words = pc.cast(pa.array(list(total), pa.binary()), pa.string())
            batch = pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                raw = part.column(part.schema.get_field_index("text")).cast(pa.large_binary())
                for name, text in zip(part.column(part.schema.get_field_index("id")).to_pylist(), raw.to_pylist()):
                    # bytes.lower() changes A-Z alone; shorter runs can give no word
                    own = Counter(run.findall(text.lower()))
                    salt = zlib.crc32(name.encode() + b":")
                    for w, n in own.items():
                        h = zlib.crc32(w, salt)
                        if h % SALT_DIVISOR == 0:
                            letters = w.decode()
                            at = h % len(letters)
                            if len(letters) == least:
                                continue
                            w = (letters[:at] + letters[at + 1:]).encode()
                        total[w] += n
                if len(total) >= HELD:
                    yield out()
        if total:
            yield out()
    return count


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LETTERS) -> DataFrame:
    """(word, n): letter runs of at least `least` letters with planted misspellings, and how often they occur.

    A run whose crc32 of `id:run` is divisible by 97 loses the letter that
    the same number picks.  Tasks count their own words before they move.
    """
    rows = df.select(C.id_text(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_counter(least), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _cell(word: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(word, np.uint8) % CLASSES, minlength=CLASSES)


_TILES = "cell array<smallint>, tile int, words binary, n array<long>"


def _with_cells(batches):
    """word, n -> word, n, cell."""
    for batch in batches:
        words = batch.column(batch.schema.get_field_index("word")).to_pylist()
        cells = [_cell(w.encode("latin-1")).tolist() for w in words]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int16()))],
                                         [*batch.schema.names, "cell"])


def _neighbours(batches):
    """cell, tile -> cell, tile, to: the cell itself and, once for each pair of cells, those an edit away."""
    for batch in batches:
        out: dict[str, list] = {"cell": [], "tile": [], "to": []}
        for cell, tile in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            near = [cell]
            for i in range(CLASSES):
                more = cell.copy()
                more[i] += 1
                near.append(more)
                for j in range(i):
                    if cell[j]:
                        moved = more.copy()
                        moved[j] -= 1
                        near.append(moved)
            out["cell"] += [cell] * len(near)
            out["tile"] += [tile] * len(near)
            out["to"] += near
        cells = pa.list_(pa.int16())
        yield pa.RecordBatch.from_arrays([pa.array(out["cell"], cells), pa.array(out["tile"], pa.int32()),
                                          pa.array(out["to"], cells)], ["cell", "tile", "to"])


def _letters(payload: bytes, size: int) -> np.ndarray:
    return np.frombuffer(payload, np.uint8).reshape(-1, size)


def _counts(letters: np.ndarray) -> np.ndarray:
    n = len(letters)
    place = (np.arange(n)[:, None] * _LETTERS + _COLUMN[letters]).ravel()
    return np.bincount(place, minlength=n * _LETTERS).reshape(n, _LETTERS).astype(np.float32)


def near_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): rows of letters one edit apart; right rows are as long as the left ones, or one letter longer."""
    a, b = _counts(left), _counts(right)
    apart = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    i, j = np.nonzero(apart <= 2)
    x, y = left[i], right[j]
    size = left.shape[1]
    if right.shape[1] == size:
        one = (x != y).sum(1) == 1
    else:
        # equal letters from the front and from the back must cover the shorter word
        front = np.where((x != y[:, :size]).any(1), (x != y[:, :size]).argmax(1), size)
        back = x[:, ::-1] != y[:, :0:-1]
        one = front + np.where(back.any(1), back.argmax(1), size) >= size
    return i[one], j[one]


_EDGE = "word string, form string, n long, form_n long"


def _products(batches):
    """Rows (words, n, words2, n2, size, size2, same) of tile pairs -> both directions of each near pair.

    Rows of one left tile come together: their right tiles of one length are
    multiplied as one matrix, up to RIGHT words.
    """
    def edges(group, words, counts, size, size2):
        left = _letters(words, size)
        right = np.concatenate([_letters(g[0], size2) for g in group])
        n2 = np.concatenate([np.asarray(g[1]) for g in group])
        i, j = near_pairs(left, right)
        if group[0][2]:  # a tile with itself: each pair once
            once = i < j
            i, j = i[once], j[once]
        n1 = np.asarray(counts)
        x, y = left[i], right[j]
        def text(rows):
            return [bytes(r).decode("latin-1") for r in rows]
        a, b = text(x), text(y)
        return pa.RecordBatch.from_arrays(
            [pa.array(a + b, pa.string()), pa.array(b + a, pa.string()),
             pa.array(np.concatenate([n1[i], n2[j]]), pa.int64()), pa.array(np.concatenate([n2[j], n1[i]]), pa.int64())],
            ["word", "form", "n", "form_n"])

    key, group, held = None, [], 0
    for batch in batches:
        for r in sorted(batch.to_pylist(), key=lambda r: (r["words"], r["size2"], r["same"])):
            mine = (r["words"], r["size"], r["size2"], r["same"])
            if group and (mine != key[0] or held + len(r["n2"]) > RIGHT):
                yield edges(group, key[0][0], key[1], *key[0][1:3])
                group, held = [], 0
            key = (mine, r["n"])
            group.append((r["words2"], r["n2"], r["same"]))
            held += len(r["n2"])
    if group:
        yield edges(group, key[0][0], key[1], *key[0][1:3])


def tiles(words: DataFrame, most: int = TILE) -> DataFrame:
    """(cell, tile, size, words, n): about `most` words of a cell, in Latin-1, one after the other, with their counts."""
    celled = words.mapInArrow(_with_cells, T.StructType([*words.schema.fields, T.StructField("cell", T.ArrayType(T.ShortType()))]))
    per = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("__tiles"))
    dealt = celled.join(per, "cell").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("__tiles")).cast("int"))
    listed = dealt.groupBy("cell", "tile").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("w"))
    return listed.select("cell", "tile", F.aggregate("cell", F.lit(0), lambda s, x: s + x).alias("size"),
                         F.encode(F.array_join("w.word", ""), "ISO-8859-1").alias("words"), F.col("w.n").alias("n"))


def near_words(words: DataFrame, most: int = TILE) -> DataFrame:
    """(word, form, n, form_n): every ordered pair of words one edit apart.

    words: (word, n), distinct, of a-z and U+00C0 to U+00FF.
    """
    own = tiles(words, most).checkpoint()
    keys = own.select("cell", "tile")
    cells = "array<smallint>"
    ask = keys.mapInArrow(_neighbours, f"cell {cells}, tile int, to {cells}")
    other = keys.select(F.col("cell").alias("to"), F.col("tile").alias("tile2"))
    same = F.col("cell") == F.col("to")
    pairs = ask.join(other, "to").where(~same | (F.col("tile") <= F.col("tile2")))
    right = own.select(F.col("cell").alias("to"), F.col("tile").alias("tile2"), F.col("size").alias("size2"),
                       F.col("words").alias("words2"), F.col("n").alias("n2"))
    met = pairs.join(right, ["to", "tile2"]).join(own, ["cell", "tile"]).select(
        "words", "n", "size", "words2", "n2", "size2", (same & (F.col("tile") == F.col("tile2"))).alias("same"))
    return met.mapInArrow(_products, _EDGE)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last.

    forms: (word, form), form not null.  Each round doubles the steps that a
    word has gone; a form has at least twice the count of its word, so the
    rounds are few (6 for counts below 2^64).
    """
    now = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        after = now.join(step, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("__moved")).checkpoint()
        moved = after.where("__moved").limit(1).count()
        now = after.drop("__moved")
        if not moved:
            return now


def group(words: DataFrame, ratio: int = RATIO, most: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of (word, n).

    form: the near word of greatest n (ties: the least in code-point order)
    if its n is at least `ratio` times the word's own, else null.
    """
    words = words.select("word", "n").checkpoint()
    best = F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))
    near = near_words(words, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(best).alias("best"))
    fits = -F.col("best.n") >= F.col("n") * ratio
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.form")).alias("form"),
        F.when(fits, -F.col("best.n")).alias("form_n")).checkpoint()
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame, least_count: int = LEAST_COUNT, most: int = TILE) -> DataFrame:
    """The variants among all words of the documents.

    Null texts hold no words; a null id counts as the empty text; repeated
    rows count as often as they stand; no documents, no rows.  Other columns
    are not read.
    """
    return group(word_counts(docs).where(F.col("n") >= least_count), most=most)
