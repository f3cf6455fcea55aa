"""Fill-in-the-middle transformation: texts cut at two seeded places and put together anew.

Batches of Arrow rows are registered in a DuckDB database of the task, and one SQL statement does the rest: regexp_extract_all cuts
a text into units of UNIT code points, and the units that a cut falls into into single ones; list_slice takes the parts on either side;
array_to_string joins them; sha256 of the seed and the id gives the draws. Lists of whole units keep a text's lists at a small
multiple of its size, so a text of many megabytes is no list of as many strings; batches are sliced by bytes before they are registered.

The draws of a row are the first four groups of eight hexadecimal digits of sha256("seed:id"). The prefix ends after the smaller of the
first two modulo n + 1, the middle after the larger. The third keeps a text plain, the fourth chooses the form:
psm is <P>prefix<S>suffix<M>middle, spm is <S>suffix<P>prefix<M>middle.

Defined results: a null text is the empty text, which stays plain, as does a text that holds a marker; a null id is drawn as the empty string,
so all rows without an id have one draw; repeated rows give equal rows; columns beyond the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = "1", 90, 20
#: Code points of a unit, and bytes of text that one statement works on; a longer text is a statement of its own.
UNIT, SLICE_BYTES = 256, 4_000_000
OUT = "doc_id string, n long, form string, prefix_chars long, middle_chars long, output string"


def _statement(rate: int, spm_rate: int, seed: str) -> str:
    chars = lambda cell: f"regexp_extract_all(coalesce({cell}, ''), '(?s).')"
    join = lambda cells: f"array_to_string({cells}, '')"
    draw = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS UBIGINT)"
    return f"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '(?s).{{1,{UNIT}}}') AS u, sha256('{seed}:' || coalesce(doc_id, '')) AS h FROM batch),
sized AS (SELECT *, CAST(CASE WHEN len(u) = 0 THEN 0 ELSE (len(u) - 1) * {UNIT} + len({chars('u[-1]')}) END AS BIGINT) AS n FROM cut),
drawn AS (SELECT *, CAST({draw(0)} % CAST(n + 1 AS UBIGINT) AS BIGINT) AS x, CAST({draw(1)} % CAST(n + 1 AS UBIGINT) AS BIGINT) AS y,
  CASE WHEN n = 0 OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR {draw(2)} % 100 >= {rate} THEN 'plain' WHEN {draw(3)} % 100 < {spm_rate} THEN 'spm' ELSE 'psm' END AS form FROM sized),
ends AS (SELECT *, least(x, y) AS p, greatest(x, y) AS q, least(x, y) // {UNIT} AS pu, greatest(x, y) // {UNIT} AS qu FROM drawn),
near AS (SELECT *, CASE WHEN form <> 'plain' THEN {chars('u[pu + 1]')} END AS pc, CASE WHEN form <> 'plain' THEN {chars('u[qu + 1]')} END AS qc FROM ends),
parts AS (SELECT *, {join('list_slice(u, 1, pu)')} || {join(f'list_slice(pc, 1, p % {UNIT})')} AS prefix,
  CASE WHEN pu = qu THEN {join(f'list_slice(pc, p % {UNIT} + 1, q % {UNIT})')}
       ELSE {join(f'list_slice(pc, p % {UNIT} + 1, {UNIT})')} || {join('list_slice(u, pu + 2, qu)')} || {join(f'list_slice(qc, 1, q % {UNIT})')} END AS middle,
  {join(f'list_slice(qc, q % {UNIT} + 1, {UNIT})')} || {join('list_slice(u, qu + 2, len(u))')} AS suffix FROM near)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
  CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END AS output FROM parts"""


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """b in runs of rows with SLICE_BYTES of text at most, or one row."""
    from pyarrow import compute as pc

    size, start, held = pc.fill_null(pc.binary_length(b.column("text")), 0).to_pylist(), 0, 0
    for i, n in enumerate(size):
        if i > start and held + n > SLICE_BYTES:
            yield b.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(size):
        yield b.slice(start)


def transform(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rate: int = RATE, spm_rate: int = SPM_RATE, seed: str = SEED) -> DataFrame:
    """doc_id, n (code points of the text), form, prefix_chars, middle_chars and output of each row of docs; the id keeps its type.

    Of 100 texts `rate` are transformed on average, of 100 of these `spm_rate` have the suffix first.
    """
    sql = _statement(int(rate), int(spm_rate), seed.replace("'", "''"))
    kind = docs.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        names = [c.split()[0] for c in OUT.split(", ")]
        con = duckdb.connect(config={"threads": 1, "temp_directory": ""})  # a task has one core, and spills nothing to a local folder
        try:
            for b in batches:
                for part in _slices(b):
                    con.register("batch", pa.Table.from_batches([part]))
                    yield from con.sql(sql).to_arrow_table().select(names).to_batches()
                    con.unregister("batch")
        finally:
            con.close()

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, OUT).withColumn("doc_id", F.col("doc_id").cast(kind))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of. No part holds a marker, so each marker stands once."""
    first = F.substring(output, len(PREFIX) + 1, F.length(output))
    between = lambda a, b: F.split_part(F.split_part(first, F.lit(a), F.lit(1)), F.lit(b), F.lit(1))
    after = lambda mark: F.split_part(first, F.lit(mark), F.lit(2))
    middle = after(MIDDLE)
    psm = F.concat(between(SUFFIX, MIDDLE), middle, F.split_part(after(SUFFIX), F.lit(MIDDLE), F.lit(1)))
    spm = F.concat(F.split_part(after(PREFIX), F.lit(MIDDLE), F.lit(1)), middle, between(PREFIX, MIDDLE))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
