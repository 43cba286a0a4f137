"""Tables that the registered queries derive from the supplied ones, as one SQL text for Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Elements: documents are suppliers, pages come from parts, types and texts from keys, boxes from quantities and rates.
#: k and m are digits, r is k in Roman; some boxes lack a side or all, some documents have no text blocks, some texts are null or empty.
ELEMENTS = """
SELECT doc_id, page_num, ordinal,
       concat(doc_id, '-', lpad(CAST(ordinal AS STRING), 6, '0')) AS element_id,
       CAST(row_number() OVER (PARTITION BY doc_id, page_num ORDER BY ordinal) - 1 AS INT) AS reading_order,
       element_type, section_path, x0, y0, x1, y1, k, m,
       CASE
         WHEN element_type IN ('text_block', 'list_block') THEN CASE v
           WHEN 0 THEN concat('See Table ', k, ' and Fig. ', m, ' for details.')
           WHEN 1 THEN concat('The following equation gives Eq. ', k, ' of the model.')
           WHEN 2 THEN 'Plain words about parts.'
           WHEN 3 THEN concat('As shown in Figure ', k, '.', m, ', tables help: see Table ', r, '.')
           WHEN 4 THEN concat('Compare figure ', k, 'B, Figure ', k, 'B and Chart ', k, '-', m, ', not the charts.')
           WHEN 5 THEN concat('We refer to  formula ', k, ' and in equation form to Eqn. ', k, '.', m, '.')
           WHEN 7 THEN ''
           WHEN 8 THEN concat(k, '.', m, ' Scope of the parts')
           WHEN 9 THEN 'References'
           WHEN 10 THEN '42'
           WHEN 11 THEN concat('From table of prices: Exhibit A, appendix C-D; Listing ', k, '.', m, '.', k, ' and the image.') END
         WHEN element_type = 'table' THEN CASE v
           WHEN 0 THEN concat('Table ', k, '.', m, ' Overview') WHEN 1 THEN concat('TABLE ', r, '. Totals')
           WHEN 2 THEN 'Prices without a number' WHEN 3 THEN NULL ELSE concat('Table ', k, ': Values') END
         WHEN element_type IN ('image', 'chart', 'graph') THEN CASE v
           WHEN 0 THEN concat('Fig. ', k, '.', m, ': Share') WHEN 1 THEN concat('Chart ', k, 'B of sales') WHEN 2 THEN 'Photo of parts'
           WHEN 3 THEN NULL ELSE concat('Figure ', m, ' of sales') END
         WHEN element_type = 'formula' THEN CASE v
           WHEN 0 THEN concat('$$x_', k, ' = ', m, '$$') WHEN 1 THEN concat('Eq. ', k, '.', m) ELSE concat('Equation ', k) END
         WHEN element_type = 'caption' THEN CASE
           WHEN v < 4 THEN concat('Table ', k, ': Overview.') WHEN v < 7 THEN concat('Fig. ', m, 'B: The image.')
           WHEN v = 7 THEN concat('Figure ', r, ' – shares') WHEN v = 8 THEN concat('Equation ', k, ' defines it') ELSE 'Notes on the page' END
         WHEN element_type = 'section_header' THEN CASE
           WHEN v < 4 THEN concat(k, '.', m, ' Title') WHEN v < 7 THEN concat('Section ', k, ': Results') WHEN v = 7 THEN concat('Chapter ', k, ' The parts')
           WHEN v = 8 THEN 'Appendix B' WHEN v = 9 THEN concat('A.', k, ' More') ELSE 'Introduction' END
         ELSE 'Running text' END AS content
FROM (
  SELECT doc_id, page_num, ordinal, section_path, x0, CASE WHEN gap = 1 THEN NULL ELSE y0 END AS y0, x1, CASE WHEN gap < 2 THEN NULL ELSE y1 END AS y1, k, m, r, v,
         CASE WHEN silent AND element_type IN ('text_block', 'list_block') THEN 'footnote' ELSE element_type END AS element_type
  FROM (
    SELECT CAST(l_suppkey AS STRING) AS doc_id, CAST(1 + l_partkey % 20 AS INT) AS page_num,
           row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate) AS ordinal,
           CASE (l_orderkey + l_linenumber) % 12
             WHEN 0 THEN 'text_block' WHEN 1 THEN 'table' WHEN 2 THEN 'image' WHEN 3 THEN 'chart' WHEN 4 THEN 'graph' WHEN 5 THEN 'formula' WHEN 6 THEN 'caption'
             WHEN 7 THEN 'footnote' WHEN 8 THEN 'header' WHEN 9 THEN 'footer' WHEN 10 THEN 'list_block' ELSE 'section_header' END AS element_type,
           CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE concat('s', CAST(l_linenumber % 4 AS STRING)) END AS section_path,
           l_quantity / 64.0 AS x0, l_discount * 8.0 AS y0, l_quantity / 64.0 + 0.05 + l_tax AS x1, l_discount * 8.0 + 0.02 + l_tax AS y1,
           CAST(l_partkey % 9 + 1 AS STRING) AS k, CAST(l_suppkey % 5 + 1 AS STRING) AS m,
           split_part('I,II,III,IV,V,VI,VII,VIII,IX', ',', CAST(l_partkey % 9 + 1 AS INT)) AS r,
           (7 * l_orderkey + l_partkey) % 12 AS v, (l_orderkey + l_partkey) % 31 AS gap, l_suppkey % 25 = 3 AS silent
    FROM {lineitem}
  ) AS keyed
) AS raw
"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: ELEMENTS for Spark: doc_id is there before the windows, so that one exchange by it serves both of them and whatever stays in a document.
#: Whatever is read comes into the order, last: so plans that need different columns need the same exchange, and share it.
_BY_DOCUMENT = ELEMENTS.replace("CAST(l_suppkey AS STRING) AS doc_id", "doc_id").replace("PARTITION BY l_suppkey", "PARTITION BY doc_id").replace(
    "l_shipdate) AS ordinal", "l_shipdate, l_quantity, l_discount, l_tax, l_suppkey) AS ordinal",
)


#: The fields of a row that ELEMENTS reads besides l_suppkey, and how two numbers hold them: word, lowest bit, bits, parts of one (None: a date).
_PACKED = {
    "l_orderkey": (0, 31, 32, 1), "l_partkey": (0, 4, 27, 1), "l_linenumber": (0, 0, 4, 1),
    "l_extendedprice": (1, 36, 27, 100), "l_quantity": (1, 29, 7, 1), "l_discount": (1, 22, 7, 100), "l_tax": (1, 17, 5, 100), "l_shipdate": (1, 0, 17, None),
}


def packed(lines: DataFrame) -> DataFrame:
    """doc_id (the supplier's number), w0, w1, rest: rows of lineitem in less than half the bytes. w0 and w1 have all fields of a row whose fields fit
    and come back from there to the bit, else rest has them as they are."""
    kinds, fits, words = dict(lines.dtypes), [], [[], []]
    for c, (word, at, bits, parts) in _PACKED.items():
        if parts is None:  # at midnight
            n, back, inside = f"unix_date(CAST({c} AS DATE))", f"CAST(CAST({c} AS DATE) AS {kinds[c]})", f"CAST({c} AS DATE) BETWEEN DATE'1970-01-01' AND date_from_unix_date({2**bits - 1})"
        elif kinds[c] in ("double", "float"):
            n, inside = f"CAST({c} * {parts}D + 0.5D AS BIGINT)", f"{c} BETWEEN 0D AND {(2**bits - 1) / parts}D AND NOT ({c} = 0 AND CAST({c} AS STRING) = '-0.0')"
            back = f"{n} / {parts}D"
        else:
            n, back, inside = c, f"CAST(CAST({c} AS BIGINT) AS {kinds[c]})", f"{c} BETWEEN 0 AND {2**bits - 1}"
        fits.append(f"CASE WHEN {inside} THEN {back} = {c} ELSE false END")
        words[word].append(f"shiftleft(CAST({n} AS BIGINT), {at})")
    row = lines.selectExpr("l_suppkey AS doc_id", *_PACKED, f"{' AND '.join(fits)} AS fits")
    return row.selectExpr("doc_id", *[f"CASE WHEN fits THEN {' | '.join(w)} END AS w{k}" for k, w in enumerate(words)], f"CASE WHEN NOT fits THEN struct({', '.join(_PACKED)}) END AS rest")


def unpacked(rows: DataFrame) -> DataFrame:
    """The fields of packed(), with doc_id and l_suppkey."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema["rest"].dataType}

    def one(c: str) -> str:
        word, at, bits, parts = _PACKED[c]
        n = f"shiftright(w{word}, {at}) & {2**bits - 1}L"
        n = f"date_from_unix_date(CAST({n} AS INT))" if parts is None else f"({n}) / {parts}D" if kinds[c] in ("double", "float") else n
        return f"CASE WHEN rest IS NULL THEN CAST({n} AS {kinds[c]}) ELSE rest.{c} END AS {c}"

    return rows.selectExpr("doc_id", "doc_id AS l_suppkey", *[one(c) for c in _PACKED])


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ELEMENTS with the box columns that the operators take, dealt by doc_id."""
    return _boxed(spark, read(spark, sf_dir, "lineitem").withColumn("doc_id", F.col("l_suppkey").cast("string")).repartition("doc_id"))  # what is computed comes after


def narrow(spark: SparkSession, sf_dir: str, rows: int) -> DataFrame:
    """elements() whose doc_id is a number, dealt packed, to more tasks than usual if these would get more than so many rows each."""
    lines = read(spark, sf_dir, "lineitem")
    n = lines.count() // rows + 1  # by the footers of the files
    return _boxed(spark, unpacked(packed(lines).repartition(*([n] if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else []), "doc_id")))


def _boxed(spark: SparkSession, lines: DataFrame) -> DataFrame:
    return spark.sql(_BY_DOCUMENT, lineitem=lines).withColumnsRenamed({"x0": "left", "y0": "top", "x1": "right", "y1": "bottom"})


#: The same as the first part of a DuckDB query.
WITH = "WITH RECURSIVE el AS MATERIALIZED (" + ELEMENTS.replace("{lineitem}", "lineitem") + ")"
