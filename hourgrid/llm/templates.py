"""Line dedup with a log-template tree.

A line is parsed along a tree of fixed depth: its number of tokens, then its first ``LEAD``
tokens, with tokens that hold a digit generalised to ``<*>`` at once. The first template of the
leaf reached is its most frequent line. Lines of the leaf that agree with it in ``SIMILAR_PCT``
of the token places are instances of it, whatever stands in the other places. What is not in a
recurring template then goes through ``further``, level by level, where a leaf gets as many
templates as recur. Templates found in ``MIN_DOCS`` documents or more recur: only their
first line stays.

Counting goes over narrow rows (leaf, digest) that are summed map-side, so a line in a third
of all documents is one row a task. Only leaves with enough lines are looked at again.
Only built-in DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hourgrid.llm.frames import stored, table

LEAD, SIMILAR_PCT, MIN_DOCS = 3, 70, 10
BIG = (1 << 63) - 1
#: A token with a digit; tried at token starts only, so a long token costs one scan.
FIELD = "(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D0-9]*+[0-9][^\\x20\\x09-\\x0D]*+"


def parsed(line: Column) -> Column:
    """Tokens joined by one space, fields generalised; the replacements are tried on lines that need them."""
    general = F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, "<*>")).otherwise(line)
    single = F.when(line.rlike("[\\x09-\\x0D]|\\x20\\x20"), F.regexp_replace(general, "[\\x20\\x09-\\x0D]+", " ")).otherwise(general)
    return F.trim(single)


def with_lines(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``doc, row, at, norm, leaf, digest`` of every line with a token."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(BIG)).alias("doc"), F.col(text).cast("string").alias("text"))
    lines = rows.select("doc", F.md5(F.col("text").cast("binary")).alias("row"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    lines = lines.filter(F.col("line").rlike("[^\\x20\\x09-\\x0D]")).select("doc", "row", "at", parsed(F.col("line")).alias("norm"))
    return lines.select("*", leaf(F.col("norm")).alias("leaf"), F.md5(F.col("norm").cast("binary")).alias("digest"))


def leaf(norm: Column) -> Column:
    tokens = F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1
    return F.concat_ws(" ", tokens.cast("string"), F.substring_index(norm, " ", LEAD))


def _misses(tokens: Column) -> Column:
    """Token places of a line in which an instance of its template may differ; ``tokens`` are those behind the lead."""
    return F.floor((F.size(tokens) + LEAD) * (100 - SIMILAR_PCT) / F.lit(100)).cast("int")


def _bands(df: DataFrame, *ids: str) -> DataFrame:
    """Runs of ``tokens``, more of them than places may differ: what is alike has one in common."""
    width = F.floor(F.size("tokens") / (_misses(F.col("tokens")) + 1)).cast("int")
    runs = F.sequence(F.lit(0), F.floor(F.size("tokens") / width).cast("int") - 1)
    return df.select("leaf", *ids, F.posexplode(F.transform(runs, lambda k: F.array_join(F.slice("tokens", k * width + 1, width), "\n"))).alias("nth", "band"))


def _alike(lines: DataFrame, patterns: DataFrame) -> DataFrame:
    """``leaf, digest, template`` of the lines alike to a pattern: of several, the one in most documents."""
    pairs = _bands(lines, "digest").join(_bands(patterns, "template"), ["leaf", "nth", "band"]).select("leaf", "digest", "template").distinct()
    full = pairs.join(lines, ["leaf", "digest"]).join(patterns.withColumnRenamed("tokens", "pattern"), ["leaf", "template"])
    differ = F.size(F.filter(F.zip_with("tokens", "pattern", lambda a, b: a != b), lambda x: x))
    best = full.filter(differ <= _misses(F.col("tokens"))).groupBy("leaf", "digest").agg(F.max(F.struct("docs", "template")).alias("best"))
    return best.select("leaf", "digest", F.col("best.template").alias("template"))


def further(places: DataFrame, lines: DataFrame, min_docs: int) -> DataFrame | None:
    """``leaf, digest, template`` of the lines that are in a recurring template beside the leaf's first; None without any.

    ``places`` (``doc, row, leaf, digest``) are the lines where they stand, ``lines`` (``leaf,
    digest, tokens, found``) the distinct ones with their tokens behind the lead.

    A level masks of every line the token places whose token is rarest there among the lines of
    the leaf, as many as may differ from a template; places as frequent as the first one too many
    stay. Lines that are equal then are a template if they are in ``min_docs`` documents, all of
    a leaf's at once. The other lines alike to one of those join it, what is left goes to the next
    level, with counts of its own, until a level finds no template.
    """
    out = None
    while True:
        cells = lines.select("leaf", "digest", "found", F.posexplode("tokens").alias("place", "token"))
        held = cells.groupBy("leaf", "place", "token").agg(F.sum("found").alias("held"))
        cells = cells.join(held, ["leaf", "place", "token"]).groupBy("leaf", "digest").agg(
            F.sort_array(F.collect_list(F.struct("place", "token", "held"))).alias("cells"))
        least = F.element_at(F.sort_array("cells.held"), _misses(F.col("cells")) + 1)
        # a token has no space
        masked = F.transform("cells", lambda c: F.when(c["held"] < F.col("least"), " ").otherwise(c["token"]))
        keyed = cells.withColumn("least", least).filter(F.col("least") >= min_docs).select("leaf", "digest", masked.alias("masked"))
        keyed = stored(keyed.withColumn("template", F.md5(F.array_join("masked", "\n").cast("binary"))), "masked")
        docs = places.join(keyed.select("leaf", "digest", "template"), ["leaf", "digest"]).select("leaf", "template", "doc", "row").distinct()
        docs = docs.groupBy("leaf", "template").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs)
        patterns = stored(docs.join(keyed.groupBy("leaf", "template").agg(F.first("masked").alias("tokens")), ["leaf", "template"]), "patterns")
        if patterns.isEmpty():
            return out
        equal = keyed.join(patterns.select("leaf", "template"), ["leaf", "template"]).select("leaf", "digest", "template")
        rest = lines.join(equal, ["leaf", "digest"], "left_anti").select("leaf", "digest", "tokens")
        taken = stored(equal.union(_alike(rest, patterns)), "further")
        out = taken if out is None else out.union(taken)
        places = places.join(taken, ["leaf", "digest"], "left_anti")
        lines = stored(lines.join(taken, ["leaf", "digest"], "left_anti"), "unmatched")


def _again(found: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """``doc, row, at`` of the lines that are not the first of a recurring template, and those templates."""
    place = F.min(F.struct("doc", "row", "at"))
    recurring = (found.groupBy("leaf", "template", "doc", "row").agg(F.min("at").alias("at"))
                 .groupBy("leaf", "template").agg(F.count("*").alias("docs"), place.alias("first")).filter(F.col("docs") >= min_docs))
    recurring = stored(recurring, "recurring")
    gone = found.join(recurring, ["leaf", "template"]).filter(F.struct("doc", "row", "at") != F.col("first"))
    return gone.select("doc", "row", "at"), recurring


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` less its recurring lines, and ``n_lines, n_dropped``.

    The first line of a template is the one with the smallest id (null last), then text digest
    and line number. Lines without a token stay. A null text stays null and has no lines;
    repeated rows count as one document and lose the same lines (each
    counts where the most frequent line of a leaf is chosen). Input columns named like the
    two counts are replaced.
    """
    all_ = with_lines(docs, id_col, text)
    # narrow counts: a template needs as many lines as documents
    counted = all_.groupBy("leaf", "digest").agg(F.count("*").alias("found"))
    leaves = stored(counted.groupBy("leaf").agg(F.sum("found").alias("found"), F.max(F.struct("found", "digest")).alias("top"))
                    .filter(F.col("found") >= min_docs).select("leaf", F.col("top.digest").alias("top")), "leaves")
    lines = stored(all_.join(leaves, "leaf"), "lines")
    tops = lines.filter("digest = top").groupBy("leaf").agg(F.first(F.split("norm", " ")).alias("top_tokens"))
    tokens = F.split("norm", " ")
    same = F.size(F.filter(F.zip_with(tokens, F.col("top_tokens"), lambda a, b: a == b), lambda x: x))
    alike = same * 100 >= SIMILAR_PCT * F.size(tokens)
    found = lines.join(tops, "leaf").select("doc", "row", "at", "leaf", "digest", F.when(alike, F.col("top")).alias("template"))
    found = stored(found, "templates")
    gone, recurring = _again(found.filter("template IS NOT NULL"), min_docs)
    rest = found.join(recurring, ["leaf", "template"], "left_anti").drop("template")
    # up to one token behind the lead, a leaf's lines are all alike
    rest = rest.filter(F.substring_index("leaf", " ", 1).cast("int") > LEAD + 1)
    wide = rest.groupBy("leaf").agg(F.count("*").alias("found")).filter(F.col("found") >= min_docs)
    rest = stored(rest.join(wide.select("leaf"), "leaf"), "rest")
    if not rest.isEmpty():
        counted = rest.groupBy("leaf", "digest").agg(F.count("*").alias("found"))
        texts = lines.join(counted, ["leaf", "digest"]).groupBy("leaf", "digest", "found").agg(F.first("norm").alias("norm"))
        behind = F.slice(F.split("norm", " "), LEAD + 1, F.length("norm"))
        named = further(rest, stored(texts.select("leaf", "digest", "found", behind.alias("tokens")), "unmatched"), min_docs)
        if named is not None:
            gone = gone.union(_again(rest.join(named, ["leaf", "digest"]), min_docs)[0])
    gone = gone.groupBy("doc", "row").agg(F.collect_set("at").alias("gone"))
    keyed = docs.withColumns({"__doc": F.coalesce(F.col(id_col).cast("long"), F.lit(BIG)), "__row": F.md5(F.col(text).cast("string").cast("binary"))})
    joined = keyed.join(gone.select(F.col("doc").alias("__doc"), F.col("row").alias("__row"), F.col("gone").alias("__gone")), ["__doc", "__row"], "left")
    parts = F.split(F.col(text).cast("string"), "\n", -1)
    rest = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__gone"))
    cut = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(
        F.array_join(F.transform(rest, lambda i: F.element_at(parts, i + 1)), "\n"))
    out = joined.withColumns({"__cut": cut, "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long"),
                              "n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("long")})
    return out.withColumn(text, F.col("__cut")).select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")


def op2_line_templates(spark, sf_dir: str) -> DataFrame:
    out = drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", "text")


#: One common table expression after another; ``{docs}`` is the input.
ORACLE_STEPS = """
t_rows AS (
  SELECT COALESCE(doc_id, 9223372036854775807) AS doc, md5(text) AS row, string_split(text, chr(10)) AS parts FROM {docs}
), t_lines AS (
  SELECT doc, row, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM t_rows
), t_norm AS (
  SELECT doc, row, line_no, trim(regexp_replace(regexp_replace(line, '[^\\x20\\x09-\\x0D]*[0-9][^\\x20\\x09-\\x0D]*', '<*>', 'g'),
         '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS norm FROM t_lines
), t_leaf AS (
  SELECT *, string_split(norm, ' ') AS tokens,
         array_to_string(list_concat([CAST(len(string_split(norm, ' ')) AS VARCHAR)], string_split(norm, ' ')[1:3]), ' ') AS leaf,
         md5(norm) AS digest
  FROM t_norm WHERE norm <> ''
), t_top AS (
  SELECT leaf, max_by(digest, (found, digest)) AS top
  FROM (SELECT leaf, digest, count(*) AS found FROM t_leaf GROUP BY leaf, digest) GROUP BY leaf
  HAVING sum(found) >= 10
), t_tops AS (
  SELECT l.leaf, l.tokens AS top_tokens, top FROM t_top t JOIN (SELECT DISTINCT leaf, digest, tokens FROM t_leaf) l ON l.leaf = t.leaf AND l.digest = top
), t_found AS (
  SELECT doc, row, line_no, l.leaf,
         CASE WHEN 100 * len(list_filter(list_zip(tokens, top_tokens), lambda x: x[1] = x[2])) >= 70 * len(tokens) THEN top ELSE digest END AS template
  FROM t_leaf l JOIN t_tops t ON l.leaf = t.leaf
), t_recurring AS (
  SELECT leaf, template, min((doc, row, line_no)) AS first FROM t_found GROUP BY leaf, template HAVING count(DISTINCT (doc, row)) >= 10
), t_gone AS (
  SELECT doc, row, list(DISTINCT line_no) AS gone FROM t_found f JOIN t_recurring r ON f.leaf = r.leaf AND f.template = r.template
  WHERE (doc, row, line_no) <> first GROUP BY doc, row
), t_kept AS (
  SELECT d.* REPLACE (CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text),
         CAST(COALESCE(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(COALESCE(len(gone), 0) AS BIGINT) AS n_dropped
  FROM {docs} d LEFT JOIN t_gone g ON COALESCE(d.doc_id, 9223372036854775807) = g.doc AND md5(d.text) = g.row
)
"""
ORACLE = f"WITH {ORACLE_STEPS.format(docs='documents')} SELECT doc_id, n_lines, n_dropped, text FROM t_kept"
