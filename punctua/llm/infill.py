"""Fill-in-the-middle texts: units, roles and joined pieces as one pyarrow.compute pipeline."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from punctua.llm.common import frames_of, tidy

# The marks of prefix, suffix and middle, and the salt of the draws.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SALT = "7:"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draw(id_text: Column, k: int, salt: str = SALT) -> Column:
    """The ``k``-th (from 1) of the 32-bit draws of an id: 8 digits of a SHA-256; a null id draws as empty text."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(id_text, F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def lines_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Units ``[^\\n]*\\n|[^\\n]+`` of all texts: (units flat, their text's position, their ordinal in it)."""
    parts = pc.split_pattern(texts, "\n")
    flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts).to_numpy()
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    ordinal = np.arange(len(parent)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    last = ordinal == sizes[parent] - 1
    whole = pc.binary_join_element_wise(flat, pc.if_else(pa.array(last), "", "\n").cast(flat.type), pa.scalar("", flat.type))
    # What follows the last line break is a unit only if it holds something.
    real = ~(last & pc.equal(flat, "").to_numpy(zero_copy_only=False))
    return whole.filter(pa.array(real)), parent[real], ordinal[real]


def joined(units: pa.Array, parent: np.ndarray, mask: np.ndarray, n: int) -> pa.Array:
    """Per text, its units under ``mask`` as one string: rebuilt lists, then ``binary_join``."""
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(parent[mask], minlength=n), out=offsets[1:])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), units.filter(pa.array(mask)))
    return pc.binary_join(lists, pa.scalar("", units.type))


def infilled(texts: pa.Array, h: list[np.ndarray], plain_from: int, spm_below: int) -> dict[str, pa.Array]:
    """The output columns for texts without nulls and their four draws."""
    n = len(texts)
    units, parent, ordinal = lines_of(texts)
    size = np.bincount(parent, minlength=n).astype(np.int64)
    one, two = h[0] % (size + 1), h[1] % (size + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent])
    prefix, middle, suffix = (joined(units, parent, role == r, n) for r in range(3))
    marked = np.zeros(n, bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    plain = marked | (size == 0) | (h[2] % 100 >= plain_from)
    spm = h[3] % 100 < spm_below
    mark = {m: pa.scalar(m, texts.type) for m in (PREFIX, SUFFIX, MIDDLE, "")}
    as_psm = pc.binary_join_element_wise(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle, mark[""])
    as_spm = pc.binary_join_element_wise(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle, mark[""])
    is_plain, is_spm = pa.array(plain), pa.array(spm)
    chars = lambda piece: pc.if_else(is_plain, pa.scalar(None, pa.int64()), pc.utf8_length(piece).cast(pa.int64()))
    return {
        "infill": pc.if_else(is_plain, texts, pc.if_else(is_spm, as_spm, as_psm)),
        "n": pa.array(size),
        "form": pc.if_else(is_plain, PLAIN, pc.if_else(is_spm, SPM, PSM)),
        "prefix_chars": chars(prefix),
        "middle_chars": chars(middle),
    }


def fill_in_middle(docs: DataFrame, rate: int = 100, spm_rate: int = 50, salt: str = SALT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, infill, n, form, prefix_chars, middle_chars`` of every row of ``docs``.

    A text is cut into lines; two places drawn from its id part them into prefix, middle and
    suffix, written as ``form`` says.  ``rate`` percent of the texts are cut, ``spm_rate``
    percent of those with the suffix first.  Every row is on its own, so nothing is shuffled
    and a hot source or a copy costs what any row costs; tasks work on slices of about 4 MB,
    one text at least.

    Defined cases: null and empty texts are empty and plain, with n 0; texts that hold a mark
    are plain; a null id draws from the salt alone; rows sharing an id draw alike; very long
    texts are cut whole; other columns are not read, whatever their names; an empty table
    stays empty.
    """
    as_text = F.col(id_col).cast("string")
    given = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        *[draw(as_text, k, salt).alias(f"h{k}") for k in range(1, 5)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames_of(batches):
            texts = b.column("text").cast(pa.large_string())
            out = infilled(texts, [b.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(1, 5)], rate, spm_rate)
            out["infill"] = out["infill"].cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column("id"), *out.values()], ["id", *out])

    kinds = given.select("id").schema.fields + [
        T.StructField("infill", T.StringType()), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())]
    return given.mapInArrow(tidy(run), T.StructType(kinds)).withColumnRenamed("id", "doc_id")


def rebuilt(texts: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts that outputs were made from.

    No mark overlaps another or itself, and no piece holds one, so the first of each is the
    one that was written.
    """
    def after(column, mark, which):
        return pc.list_element(pc.split_pattern(column, mark, max_splits=1), which)

    out = [None] * 3
    for k, (form, first, second) in enumerate(((PSM, PREFIX, SUFFIX), (SPM, SUFFIX, PREFIX))):
        own = texts.filter(pc.equal(forms, form))
        body = after(own, first, 1)
        head, rest = after(body, second, 0), after(body, second, 1)
        tail, middle = after(rest, MIDDLE, 0), after(rest, MIDDLE, 1)
        ends = (head, tail) if form == PSM else (tail, head)
        out[k] = pc.binary_join_element_wise(ends[0], middle, ends[1], pa.scalar("", texts.type))
    out[2] = texts.filter(pc.equal(forms, PLAIN))
    codes = pc.index_in(forms, pa.array([PSM, SPM, PLAIN])).to_numpy(zero_copy_only=False)
    return pa.concat_arrays(out).take(pa.array(np.argsort(np.argsort(codes, kind="stable"), kind="stable")))


def restored(rows: DataFrame, infill: str = "infill", form: str = "form", out: str = "restored") -> DataFrame:
    """``rows`` with the exact text rebuilt from each output and its form alone.

    Null outputs give null, as plain rows do; an input column named ``out`` is replaced.
    """
    kept = [c for c in rows.columns if c != out]
    given = rows.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(kept)],
                        F.col(infill).alias("infill"), F.coalesce(F.col(form), F.lit(PLAIN)).alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames_of(batches):
            text = rebuilt(b.column("infill").cast(pa.large_string()), b.column("form").cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], text.cast(pa.string())], [*b.schema.names[:-2], "text"])

    kinds = T.StructType(given.schema.fields[:-2] + [T.StructField("text", T.StringType())])
    return given.mapInArrow(tidy(run), kinds).toDF(*kept, out)
