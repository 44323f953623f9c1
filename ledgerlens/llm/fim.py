"""Fill-in-middle transformation of documents, as a pyarrow.compute pipeline over Arrow batches.

A text is cut into lines; two cuts drawn from a hash of the document's id part the lines into
prefix, middle and suffix, which are written in prefix-suffix-middle or suffix-prefix-middle
order behind their markers.  Cuts and forms are columns that Spark computes from the id alone, so
a task that runs again writes the same text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.frames import free_name, without

# The markers of the three pieces.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Bytes of text that one pass of the pipeline holds; a longer text is a pass of its own.
SLICE_BYTES = 8 << 20

_ADDED = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit draws: the first 8-digit groups of the hex SHA-256 of ``seed:id``.
    A null id is drawn for as the text ``null``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def _slices(text: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of about SLICE_BYTES."""
    size = pc.cumulative_sum(pc.cast(pc.binary_length(text), pa.int64())).to_numpy(zero_copy_only=False)
    i, n = 0, len(text)
    while i < n:
        before = size[i - 1] if i else 0
        j = max(i + 1, int(size.searchsorted(before + SLICE_BYTES, "right")))
        yield i, j - i
        i = j


def _modulo(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _pieces(units: pa.Array, parents: pa.Array, role: pa.Array, which: int, rows: int) -> pa.Array:
    """The units of one role of every row, joined."""
    chosen = pc.equal(role, pa.scalar(which, pa.int8()))
    kept, of = pc.filter(units, chosen), pc.filter(parents, chosen)
    # rows are in order, so a row's units follow each other: list offsets are counts added up
    counts = pc.value_counts(pc.cast(of, pa.int64()))
    each = pa.array(np.zeros(rows, np.int64)) if len(counts) == 0 else pc.fill_null(pc.take(
        counts.field("counts"), pc.index_in(pa.array(np.arange(rows)), counts.field("values"))), 0)
    offsets = pc.cast(pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(each)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, kept), pa.scalar("", pa.large_string()))


def _transformed(text: pa.Array, h: list[pa.Array], rate: int, spm_rate: int) -> dict[str, pa.Array]:
    rows = len(text)
    # split at line ends: every part but a row's last one ends in the separator it lost
    parts = pc.split_pattern(text, "\n")
    flat = pc.list_flatten(parts)
    parents = pc.list_parent_indices(parts)
    ends = pc.cast(parts.offsets[1:], pa.int64())
    place = pa.array(np.arange(len(flat)))
    last = pc.equal(place, pc.subtract(pc.take(ends, parents), 1))
    units = pc.if_else(last, flat, pc.binary_join_element_wise(flat, pa.scalar("", pa.large_string()),
                                                               pa.scalar("\n", pa.large_string())))
    real = pc.not_equal(units, "")  # a text that ends in a line end has no unit after it
    units, parents = pc.filter(units, real), pc.filter(parents, real)
    counts = pc.value_counts(pc.cast(parents, pa.int64()))
    row = pa.array(np.arange(rows))
    n = (pa.array(np.zeros(rows, np.int64)) if len(counts) == 0 else
         pc.fill_null(pc.take(counts.field("counts"), pc.index_in(row, counts.field("values"))), 0))
    first = pc.subtract(pc.cumulative_sum(n), n)
    ordinal = pc.subtract(pa.array(np.arange(len(units))), pc.take(first, parents))

    one, two = (_modulo(x, pc.add(n, 1)) for x in h[:2])
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    role = pc.add(pc.cast(pc.greater_equal(ordinal, pc.take(low, parents)), pa.int8()),
                  pc.cast(pc.greater_equal(ordinal, pc.take(high, parents)), pa.int8()))
    prefix, middle, suffix = (_pieces(units, parents, role, which, rows) for which in range(3))

    hundred = pa.array(np.full(rows, 100))
    plain = pc.or_(pc.equal(text, ""), pc.greater_equal(_modulo(h[2], hundred), rate))
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(text, marker))
    spm = pc.less(_modulo(h[3], hundred), spm_rate)
    mark = {m: pa.scalar(m, pa.large_string()) for m in (PREFIX, SUFFIX, MIDDLE)}
    nothing = pa.scalar("", pa.large_string())
    as_psm = pc.binary_join_element_wise(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle, nothing)
    as_spm = pc.binary_join_element_wise(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle, nothing)
    none = pa.nulls(rows, pa.int64())
    return {
        "n": n,
        "form": pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM)),
        "prefix_chars": pc.if_else(plain, none, pc.cast(pc.utf8_length(prefix), pa.int64())),
        "middle_chars": pc.if_else(plain, none, pc.cast(pc.utf8_length(middle), pa.int64())),
        "output": pc.if_else(plain, text, pc.if_else(spm, as_spm, as_psm)),
    }


def _mapped(df: DataFrame, inputs: dict[str, Column], added: dict[str, str], work) -> DataFrame:
    """``df`` (without columns that clash with ``added``) and what ``work`` makes of ``inputs``,
    which are ``text`` and numbers, slice by slice."""
    kept = without(df, list(added))
    names, taken = {}, df
    for c in inputs:
        names[c] = free_name(taken, f"_{c}")
        taken = taken.withColumn(names[c], inputs[c])
    rest = [c for c in df.columns if c.lower() not in {a.lower() for a in added}]
    source = taken.select(*kept, *[F.col(f"`{n}`") for n in names.values()])
    # fields by position: columns of the input may share a name
    schema = ", ".join([f"_c{i} {source.schema[i].dataType.simpleString()}" for i in range(len(rest))]
                       + [f"_a{i} {kind}" for i, kind in enumerate(added.values())])

    base, more = len(rest), len(inputs) - 1  # a task gets no columns of the driver

    def run(batches):
        for batch in batches:
            whole = pc.fill_null(batch.column(base).cast(pa.large_string()), "")
            for i, size in _slices(whole):
                part = batch.slice(i, size)
                out = work(whole.slice(i, size), [part.column(base + 1 + k) for k in range(more)])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in range(base)],
                     *[pc.cast(out[a], pa.string() if kind == "string" else pa.int64()) for a, kind in added.items()]],
                    names=[f"_c{k}" for k in range(base)] + [f"_a{k}" for k in range(len(added))])

    return source.mapInArrow(run, schema).toDF(*rest, *added)


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n`` (lines), ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars``
    (code points; null if plain) and ``output``, the transformed whole text.

    The units are the lines ``[^\\n]*\\n|[^\\n]+``.  The prefix ends after the smaller of two drawn
    cuts, the middle after the larger.  ``rate`` percent of the texts are transformed, ``spm_rate``
    percent of those in suffix-prefix-middle order.  A text that holds a marker stays plain, so an
    output can always be taken apart again (``restore``).

    * null or empty text: no units, plain, empty output
    * null id: drawn for as ``null``; rows that repeat an id get the same draws
    * columns that clash with the added ones are replaced; all others pass
    * empty table: empty result
    """
    h = draws(docs[f"`{id_col}`"], seed)
    inputs = {"text": docs[f"`{text_col}`"].cast("string")} | {f"h{i + 1}": c for i, c in enumerate(h)}
    return _mapped(docs, inputs, _ADDED, lambda text, drawn: _transformed(text, drawn, rate, spm_rate))


def _after(text: pa.Array, marker: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the only ``marker`` of every text."""
    halves = pc.split_pattern(text, marker)
    return pc.list_element(halves, 0), pc.list_element(halves, 1)


def _restored(output: pa.Array, form: pa.Array) -> pa.Array:
    kinds = pc.index_in(form, pa.array([PLAIN, PSM, SPM]))
    rows, back = [], []
    for kind, (one, two) in ((1, (PREFIX, SUFFIX)), (2, (SUFFIX, PREFIX))):
        own = pc.indices_nonzero(pc.fill_null(pc.equal(kinds, kind), False))
        if len(own):
            _, rest = _after(pc.take(output, own), one)
            first, rest = _after(rest, two)
            second, middle = _after(rest, MIDDLE)
            prefix, suffix = (first, second) if kind == 1 else (second, first)
            rows.append(own)
            back.append(pc.binary_join_element_wise(prefix, middle, suffix, pa.scalar("", pa.large_string())))
    own = pc.indices_nonzero(pc.fill_null(pc.equal(kinds, 0), True))
    rows.append(own)
    back.append(pc.take(output, own))
    order = pc.sort_indices(pa.concat_arrays(rows))
    return pc.take(pa.concat_arrays([b.cast(pa.large_string()) for b in back]), order)


def restore(docs: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``docs`` with ``restored``, the text rebuilt from an output and its form alone.  Null output:
    empty; a null or unknown form is taken as plain.  An output without its markers fails."""
    code = (F.when(docs[f"`{form_col}`"] == PSM, 1).when(docs[f"`{form_col}`"] == SPM, 2).otherwise(0)).cast("bigint")
    names = pa.array([PLAIN, PSM, SPM])
    return _mapped(docs, {"text": docs[f"`{output_col}`"].cast("string"), "form": code}, {"restored": "string"},
                   lambda text, rest: {"restored": _restored(text, pc.take(names, rest[0]))})
