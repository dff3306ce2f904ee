"""Long and wide form of measures, and rows out of nested payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import violations


def wide_to_long(df: DataFrame, key: list[str], columns: dict[str, str], name: str = "measure", value: str = "value") -> DataFrame:
    """One row per key and measure; cells that are null stay rows."""
    return df.unpivot(key, [F.col(c).cast("double").alias(n) for n, c in columns.items()], name, value)


def null_cells(df: DataFrame, key: list[str], columns: dict[str, str], name: str = "measure") -> DataFrame:
    """Key and measure of every cell without a value."""
    return wide_to_long(df, key, columns, name).where("value is null").select(*key, name)


def long_to_wide(long: DataFrame, key: list[str], name: str, names: list[str], values: dict[str, str]) -> DataFrame:
    """One row per key with ``{name}_{suffix}`` for every name and value column (``values``: suffix -> column).

    ``names`` fixes the columns, so the data are read once and a measure that never occurs is a null column.
    """
    out = long.groupBy(*key).pivot(name, names).agg(*(F.first(c, ignorenulls=True).alias(s) for s, c in values.items()))
    if len(values) == 1:
        suffix = next(iter(values))
        out = out.withColumnsRenamed({n: f"{n}_{suffix}" for n in names})
    return out


def rebuilt_wide(metadata: DataFrame, long: DataFrame, key: list[str], name: str, names: list[str], values: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """A wide table rebuilt from metadata and long rows, and violations for keys that lack a measure or have one twice."""
    measures = counted_measures(long, key, name, names, values)
    wide = metadata.join(measures, key, "left")
    return wide.drop("__rows"), incomplete_keys(wide, key, names).unionAll(repeated_measures(measures, key, name))


def counted_measures(long: DataFrame, key: list[str], name: str, names: list[str], values: dict[str, str]) -> DataFrame:
    """``long_to_wide`` with the rows of each measure, (name, n), in the array ``__rows``: one aggregate by key."""
    first = [F.first(F.when(F.col(name) == n, F.col(c)), ignorenulls=True).alias(f"{n}_{s}") for n in names for s, c in values.items()]
    found = long.groupBy(*key).agg(*first, *(F.count_if(F.col(name) == n).alias(f"__rows_{i}") for i, n in enumerate(names)))
    rows = F.array(*(F.struct(F.lit(n).alias("name"), F.col(f"__rows_{i}").alias("n")) for i, n in enumerate(names)))
    return found.withColumn("__rows", rows).drop(*(f"__rows_{i}" for i in range(len(names))))


def incomplete_keys(wide: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """Keys of a table with the ``__rows`` of ``counted_measures`` that lack a measure, as violations."""
    n = F.when(F.col("__rows").isNotNull(), F.size(F.filter("__rows", lambda r: r["n"] > 0)))
    return violations(wide, "measures missing", F.coalesce(n, F.lit(0)) != len(names), key, n)


def repeated_measures(measures: DataFrame, key: list[str], name: str) -> DataFrame:
    """Keys and measures of ``counted_measures`` with several rows, as violations."""
    twice = measures.select(*key, F.explode(F.filter("__rows", lambda r: r["n"] > 1)).alias("__r")).select(*key, F.col("__r.name").alias(name), F.col("__r.n").alias("__n"))
    return violations(twice, "measure repeated", F.lit(True), [*key, name], F.col("__n"))


def changed_measures(before: DataFrame, after: DataFrame, key: list[str], name: str) -> DataFrame:
    """(before, after, n): measures whose name changed on the way, with the number of rows."""
    old, new = before.select(*key, F.col(name).alias("before")), after.select(*key, F.col(name).alias("after"))
    return old.join(new, key).where(~F.col("before").eqNullSafe(F.col("after"))).groupBy("before", "after").agg(F.count("*").alias("n"))


def enriched(rows: DataFrame, pages: DataFrame, page: list[str], columns: list[str]) -> DataFrame:
    """Rows with the columns of their page."""
    return rows.join(pages.select(*page, *columns), page)


# ---- tables in HTML


def html_rows(html: Column, row: str = "tr") -> Column:
    """The inner HTML of every row."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{row}\b[^>]*>(.*?)</{row}\s*>"), F.lit(1))


def html_cells(row: Column) -> Column:
    """The inner HTML of every cell of a row."""
    return F.regexp_extract_all(row, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), F.lit(1))


def cell_lines(cell: Column) -> Column:
    """Lines of a cell: parts between line breaks and blocks, tags removed, blanks stripped, empty lines dropped."""
    text = F.regexp_replace(cell, r"(?i)<br\s*/?>|</?(?:div|p|li)\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"<[^>]+>", "")
    lines = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), "^ | $", ""))
    return F.filter(lines, lambda x: x != "")


def table_grid(pages: DataFrame, page: list[str], html: str) -> DataFrame:
    """page, row number and cells (inner HTML) of every table row."""
    rows = pages.select(*page, F.posexplode(html_rows(F.col(html))).alias("row", "__row"))
    return rows.select(*page, "row", html_cells(F.col("__row")).alias("cells"))


def stacked_scores(pages: DataFrame, page: list[str], html: str, first_theme: int = 1) -> DataFrame:
    """Legacy layout: the first cell names the unit, every other cell stacks score, grade and band by line.

    Gives page, row, unit, link, theme_order, theme_header, raw_value, score, grade, band.
    """
    grid = table_grid(pages, page, html)
    headers = grid.where("row = 0").select(*page, F.transform("cells", lambda c: F.array_join(cell_lines(c), " ")).alias("__headers"))
    body = grid.where("row > 0").join(headers, page)
    body = body.withColumns({"unit": F.array_join(cell_lines(F.get("cells", F.lit(0))), " "), "link": F.regexp_extract(F.get("cells", F.lit(0)), r"(?i)href=[\"']([^\"']*)", 1)})
    cells = body.select(*page, "row", "unit", "link", "__headers", F.posexplode("cells").alias("theme_order", "__cell")).where(F.col("theme_order") >= first_theme)
    lines = cells.withColumn("__lines", cell_lines(F.col("__cell")))
    return lines.select(
        *page, "row", "unit", "link", "theme_order",
        F.get("__headers", F.col("theme_order")).alias("theme_header"),
        F.array_join("__lines", "|").alias("raw_value"),
        F.regexp_extract(F.get("__lines", F.lit(0)), r"-?[0-9]+(?:\.[0-9]+)?", 0).try_cast("double").alias("score"),
        F.coalesce(F.get("__lines", F.lit(1)), F.lit("")).alias("grade"),
        F.coalesce(F.get("__lines", F.lit(2)), F.lit("")).alias("band"),
    )


def paired_scores(pages: DataFrame, page: list[str], html: str, id_columns: list[str], grade_suffix: str = "-Grade") -> DataFrame:
    """Flat layout: a column ``X`` with a score and a column ``X-Grade`` with its grade.

    Gives page, row, the id columns (map by header), theme_order, theme_header, score, grade.
    """
    grid = table_grid(pages, page, html)
    grid = grid.withColumn("__text", F.transform("cells", lambda c: F.array_join(cell_lines(c), " ")))
    headers = grid.where("row = 0").select(*page, F.col("__text").alias("__headers"))
    body = grid.where("row > 0").join(headers, page).where(F.size("__text") == F.size("__headers"))
    body = body.withColumn("__by_header", F.map_from_arrays("__headers", "__text"))
    ids = F.map_filter("__by_header", lambda k, _: k.isin(id_columns)).alias("ids")
    themes = F.filter("__headers", lambda h: ~h.isin(id_columns) & ~h.endswith(grade_suffix))
    cells = body.select(*page, "row", ids, "__by_header", F.posexplode(themes).alias("theme_order", "theme_header"))
    grade = F.coalesce(F.element_at("__by_header", F.concat("theme_header", F.lit(grade_suffix))), F.lit(""))
    score = F.element_at("__by_header", F.col("theme_header")).try_cast("double")
    return cells.select(*page, "row", "ids", (F.col("theme_order") + 1).alias("theme_order"), "theme_header", score.alias("score"), grade.alias("grade"))


def select_options(pages: DataFrame, page: list[str], html: str, select_id: str, placeholders: tuple[str, ...] = ("", "0", "-1")) -> DataFrame:
    """page, position, value and label of the options of a select element, without placeholder values."""
    inner = F.regexp_extract(F.col(html), rf"(?is)<select\b[^>]*\bid=[\"']{select_id}[\"'][^>]*>(.*?)</select", 1)
    options = F.regexp_extract_all(inner, F.lit(r"(?is)<option\b([^>]*)>([^<]*)"), F.lit(0))
    rows = pages.select(*page, F.posexplode(options).alias("position", "__option"))
    value = F.regexp_extract("__option", r"(?is)\bvalue=[\"']?([^\"'\s>]*)", 1)
    label = F.regexp_replace(F.regexp_extract("__option", r"(?s)>([^<]*)$", 1), r"(?U)^\s+|\s+$", "")
    return rows.select(*page, "position", value.alias("value"), label.alias("label")).where(~F.col("value").isin(list(placeholders)))


# ---- hierarchy payloads

PAYLOAD = "columns array<string>, rows array<array<string>>"


def payload_rows(payloads: DataFrame, place: list[str], body: str, id_column: str, label_column: str = "nm", sentinel: str = "last") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (place, position, id, label) of ``{"columns": [id, label], "rows": [[id, label], ...]}``.

    A row ``[null, null]`` is a sentinel and is dropped: only as the last row (``sentinel="last"``), or anywhere
    (``"any"``). Also gives the number of sentinels per place, and violations: unreadable, wrong columns, wrong width,
    misplaced sentinel, bad id, duplicate id.
    """
    parsed = payloads.select(*place, F.from_json(body, PAYLOAD).alias("p"))
    shape = violations(parsed, "payload shape", F.coalesce(F.col("p.columns") != F.array(F.lit(id_column), F.lit(label_column)), F.lit(True)) | F.col("p.rows").isNull(), place)
    # the size stands in a step of its own: taken beside the generator, each row would carry its whole response
    sized = parsed.select(*place, F.size("p.rows").alias("__n"), F.col("p.rows").alias("__rows"))
    rows = sized.select(*place, "__n", F.posexplode("__rows").alias("position", "__row"))
    nothing = F.size(F.filter("__row", lambda x: x.isNotNull())) == 0
    dropped = nothing & ((F.col("position") == F.col("__n") - 1) if sentinel == "last" else F.lit(True))
    sentinels = rows.groupBy(*place).agg(F.count_if(dropped).alias("sentinels"))
    rows = rows.where(~dropped)
    text = F.regexp_replace(F.get("__row", F.lit(0)), r"(?U)^\s+|\s+$", "")
    good = F.when(text.rlike("^[0-9]+$") & text.rlike("[1-9]"), text)
    out = rows.select(*place, "position", good.alias("id"), F.get("__row", F.lit(1)).alias("label"), F.size("__row").alias("__width"))
    bad = violations(out, "payload row", (F.col("__width") != 2) | F.col("id").isNull() | F.col("label").isNull(), [*place, "position"])
    twice = violations(out.where("id is not null").groupBy(*place, "id").agg(F.count("*").alias("n")), "duplicate id", F.col("n") > 1, [*place, "id"])
    return out.drop("__width"), sentinels, shape.unionByName(bad).unionByName(twice)


def variant_rows(payloads: DataFrame, place: list[str], body: str, fields: dict[str, tuple[str, str]], known: list[str]) -> DataFrame:
    """Fields of JSON payloads by path and type, read as variants, and what is wrong with each payload.

    ``fields`` maps columns to (path, type). Every payload stays a row, with the whole value in ``payload``; ``problem`` is
    'unreadable' where it is no JSON, names fields whose value is not of their type, or top-level fields beyond ``known``,
    and is null if there is nothing to say.
    """
    df = payloads.withColumn("payload", F.try_parse_json(body))
    whole = F.try_variant_get("payload", "$", "map<string,variant>")
    columns, wrong = [], []
    for name, (path, kind) in fields.items():
        value = F.try_variant_get("payload", path, kind)
        columns.append(value.alias(name))
        there = F.try_variant_get("payload", path, "variant").isNotNull() & ~F.is_variant_null(F.try_variant_get("payload", path, "variant"))
        wrong.append(F.when(there & value.isNull(), F.lit(f"{name} is no {'number' if kind in ('int', 'long', 'double') else kind}")))
    extra = F.array_join(F.array_sort(F.array_except(F.map_keys(whole), F.array(*map(F.lit, known)))), ",")
    wrong.append(F.when(extra != "", F.concat(F.lit("extra: "), extra)))
    said = F.array_join(F.array_compact(F.array(*wrong)), "; ")
    problem = F.when(F.col("payload").isNull(), "unreadable").when(said != "", said)
    return df.select(*place, *columns, "payload", problem.alias("problem"))
