"""Fill-in-the-middle rewriting of whole documents, as a ``pyarrow.compute`` pipeline.

A text is a run of units: white space and the word after it, or the white space that ends
the text. Four numbers from the SHA-256 of a seed and the document's id choose two cut points
between units and one of three forms: ``plain`` (the text), ``psm`` (prefix, suffix, middle)
and ``spm`` (suffix, prefix, middle), each part behind its marker.

Per batch the texts are split into lists of units, the lists are flattened with the index of
their document, every unit gets its ordinal, the units of each part are filtered by ordinal,
lists are rebuilt from the parts' known lengths and joined. All steps are Arrow kernels over
the bytes of the texts: units are cut at ASCII characters only, and the byte 0xFF, which no
UTF-8 text holds, parts them. A batch is worked on in slices of about ``SLICE_BYTES``, so
memory follows the longest text, not the number of rows.

Rows are independent: there is no shuffle, and a lost task repeats its rows alone.

Defined results: a NULL text is empty, an empty text is plain. A NULL id is written as no
characters behind the seed. Repeated rows give repeated results. Columns other than
``doc_id`` and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

SEED = 42
FIM_PERCENT = 50  # of the documents; the others stay plain
SPM_PERCENT = 80  # of those rewritten

# fixed values: the markers before prefix, suffix and middle
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_MARKER = "<[PSM]>"

_SPACE = r"[\x20\x09-\x0D]"
_UNIT = rf"({_SPACE}*[^\x20\x09-\x0D]+|{_SPACE}+)"
_BETWEEN = b"\xff"

SLICE_BYTES = 4 << 20

_MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


def _number(digest: Column, k: int) -> Column:
    """The k-th group of eight hex digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _remainder(a: pa.Array, b) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``SLICE_BYTES`` of text; a longer text is a run by itself."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    start = size = 0
    for row, length in enumerate(lengths):
        if row > start and size + length > SLICE_BYTES:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length
    if batch.num_rows > start:
        yield batch.slice(start)


def _joined(units: pa.Array, chosen: pa.Array, counts: pa.Array) -> pa.Array:
    """The chosen units of each document, joined; ``counts`` says how many each has."""
    ends = pc.cumulative_sum(counts)
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends])
    lists = pa.LargeListArray.from_arrays(offsets, units.filter(chosen))
    return pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))


def rewrite(text: pa.Array, h: list[pa.Array]) -> dict[str, pa.Array]:
    """The result columns for texts and their four numbers."""
    text = pc.fill_null(text, "").cast(pa.large_binary())
    empty = pc.equal(pc.binary_length(text), 0)

    # split into units, flatten, number the units within their document
    marked = pc.replace_substring_regex(text, _UNIT, b"\\1" + _BETWEEN)
    lists = pc.split_pattern(marked, _BETWEEN)  # the last one is what follows the last unit: nothing
    n = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), 1)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    before = pc.subtract(pc.cumulative_sum(pc.add(n, 1)), pc.add(n, 1))
    ordinal = pc.subtract(pa.array(range(len(units)), pa.int64()), before.take(parent))

    cut = [_remainder(x, pc.add(n, 1)) for x in h[:2]]
    first, second = pc.min_element_wise(*cut), pc.max_element_wise(*cut)
    one, two, end = first.take(parent), second.take(parent), n.take(parent)
    prefix = _joined(units, pc.less(ordinal, one), first)
    middle = _joined(
        units, pc.and_(pc.greater_equal(ordinal, one), pc.less(ordinal, two)), pc.subtract(second, first)
    )
    suffix = _joined(
        units, pc.and_(pc.greater_equal(ordinal, two), pc.less(ordinal, end)), pc.subtract(n, second)
    )

    plain = pc.or_(
        pc.or_(empty, pc.match_substring_regex(text, _MARKER)),
        pc.greater_equal(_remainder(h[2], 100), FIM_PERCENT),
    )
    spm = pc.less(_remainder(h[3], 100), SPM_PERCENT)
    p, s, m, none = (pa.scalar(x, pa.large_binary()) for x in (PREFIX, SUFFIX, MIDDLE, b""))
    rebuilt = pc.if_else(
        spm,
        pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none),
    )
    missing = pa.scalar(None, pa.int64())

    def characters(part: pa.Array) -> pa.Array:
        return pc.if_else(plain, missing, pc.utf8_length(part.cast(pa.large_string())).cast(pa.int64()))

    return {
        "n": n,
        "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        "prefix_chars": characters(prefix),
        "middle_chars": characters(middle),
        "output": pc.if_else(plain, text, rebuilt).cast(pa.string()),
    }


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and the rewritten text ``output``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select("doc_id", "text", *(_number(digest, k).alias(f"h{k + 1}") for k in range(4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                made = rewrite(part.column("text"), [part.column(f"h{k}") for k in range(1, 5)])
                columns = {"doc_id": part.column("doc_id"), **made}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {_MADE}")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No text that was rewritten holds a marker, so the
    markers of an output are its only ones."""
    part = F.split(output, _MARKER, -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns: output and restored text as SHA-256."""
    return transform(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


# Lists of units, sliced at the cut points; the twin restores by the markers' places.
ORACLE_SQL = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
         ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM h),
c AS (
  SELECT *, len(units)::BIGINT AS n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
         array_to_string(units[b + 1:], '') AS s FROM c),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM p),
i AS (SELECT *, strpos(output, '<P>') AS ip, strpos(output, '<S>') AS js, strpos(output, '<M>') AS km FROM o)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
              WHEN 'psm' THEN substr(output, ip + 3, js - ip - 3) || substr(output, km + 3) || substr(output, js + 3, km - js - 3)
              ELSE substr(output, ip + 3, km - ip - 3) || substr(output, km + 3) || substr(output, js + 3, ip - js - 3) END) AS restored_sha256
FROM i
"""
