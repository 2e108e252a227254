"""Secrets in texts, judged by who owns them across the corpus. DataFrame functions only.

Base spans are the matches of three patterns. Further candidates are long mixed tokens. Every
candidate's hash is counted by distinct repositories (documents) and distinct owners (sources). A value
is copied, an example, if at least COPIED_OWNERS owners or COPIED_REPOSITORIES repositories have it; it is
live, its owner's credential, if one owner has it, it is not copied and it looks live; it is shared if it
looks live and is neither. Live candidates become spans of their own; base spans stay whatever their class is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx

COPIED_OWNERS = 3
COPIED_REPOSITORIES = 10
LIVE_LENGTH = 20
#: fixed values: the patterns of the three base kinds, in order; hex and access runs are given with their least length
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9_-]{%d,}" % LIVE_LENGTH
BASE = ("assign", "access", "hex")
_SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _starts(steps: Column) -> Column:
    """Where each match begins: running sums of (p, w), the lengths before and of the matches.

    An array that grows by one is copied each time, so the sums go by blocks of about the root of the
    number of matches, then over the blocks.
    """
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))

    def within(state, x):
        start = state["at"] + x["p"]
        return F.struct((start + x["w"]).alias("at"), F.concat(state["found"], F.array(start)).alias("found"))

    def over(state, x):
        return F.struct((state["at"] + x["at"]).alias("at"), F.concat(state["found"], F.array(state["at"])).alias("found"))

    def shifted(blocks):
        bases = F.aggregate(blocks, none, over)["found"]
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), bases.alias("base")), lambda x: F.transform(x["b"]["found"], lambda y: y + x["base"])))

    width = F.ceil(F.sqrt(F.size(steps))).cast("int")
    numbers = F.sequence(F.lit(0), F.ceil(F.size(steps) / width).cast("int") - 1)
    return _bound(F.transform(numbers, lambda n: F.aggregate(F.slice(steps, n * width + 1, width), none, within)), shifted)


def spans(text: Column, kind: str, pattern: str, group: int = 0, keep=lambda value: F.lit(True)) -> Column:
    """All matches as an array of (kind, start, end, value); positions are code points, ends exclusive.

    Splitting by a pattern gives the pieces between the matches that extracting it gives, so positions
    are running sums of lengths.
    """
    pieces = F.split(text, pattern, -1)
    whole, value = F.regexp_extract_all(text, F.lit(pattern), 0), F.regexp_extract_all(text, F.lit(pattern), group)
    steps = F.transform(
        F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("p"), whole.alias("w"), value.alias("v")),
        lambda x: F.struct(F.length(x["p"]).alias("p"), F.length(x["w"]).alias("w"), x["v"].alias("v")),
    )

    def span(x):
        start, step = x["start"], x["step"]
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + step["w"]).alias("end"), step["v"].alias("value"))

    found = _bound(steps, lambda s: F.transform(F.filter(F.arrays_zip(s.alias("step"), _starts(s).alias("start")), lambda x: keep(x["step"]["v"])), span))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def base_spans(text: Column) -> Column:
    """Assignments, access keys and hex strings, kind by kind."""
    return F.concat(
        spans(text, "assign", ASSIGN, 2, lambda v: F.length(v) >= 8),
        spans(text, "access", ACCESS),
        spans(text, "hex", HEX),
    )


def looks_live(value: Column) -> Column:
    """Letters and digits mixed, and at least eight different characters."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[A-Za-z]") & value.rlike("[0-9]") & (different >= 8)


def _joined(found: Column) -> Column:
    order = F.array(*(F.lit(k) for k in (*BASE, "live")))
    keyed = F.transform(found, lambda x: F.struct(x["start"], F.array_position(order, x["kind"]).alias("n"), x["kind"], x["end"]))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _find(rows: DataFrame, owners: int, repositories: int) -> DataFrame:
    """find_secrets over rows (row_key, doc_id, text, source); rows with one key are equal."""
    token = spans(F.col("text"), "live", TOKEN, 0, looks_live)
    rows = tx.materialized(rows.select("row_key", "doc_id", "source", base_spans(F.col("text")).alias("base"), token.alias("tokens")), "candidates")
    each = rows.select("row_key", "doc_id", "source", F.explode(F.concat("base", "tokens")).alias("c")).select(
        "row_key", "doc_id", "source", "c.kind", "c.start", "c.end", F.sha2("c.value", 256).alias("hash"), looks_live(F.col("c.value")).alias("live")
    )
    each = each.distinct()
    places = each.groupBy("hash", "source", "doc_id").agg(F.count("*").alias("n"))
    owned = places.groupBy("hash", "source").agg(F.count("*").alias("repositories"))
    seen = tx.materialized(owned.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")), "owned")
    # values of one owner are the most and need no row in the join
    judged = each.join(seen.where("owners > 1 or repositories > 1"), "hash", "left").fillna(1, ["owners", "repositories"])
    copied, extra = (F.col("owners") >= owners) | (F.col("repositories") >= repositories), F.col("kind") == "live"
    own = (F.col("owners") == 1) & ~copied & F.col("live")
    found = judged.groupBy("row_key").agg(
        F.sum(F.when(own & ~extra, 1).otherwise(0)).alias("base_live"),
        F.sum(F.when(copied & ~extra, 1).otherwise(0)).alias("n_copied"),
        F.sum(F.when(F.col("live") & ~own & ~copied, 1).otherwise(0)).alias("n_shared"),
        F.max("repositories").alias("most_repositories"), F.max("owners").alias("most_owners"),
        F.collect_list(F.when(own & extra, F.struct("kind", "start", "end"))).alias("live"),
    )
    short = "array<struct<kind:string,start:int,end:int>>"
    base = F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).cast(short)
    out = rows.join(found, "row_key", "left").select(
        "doc_id", "row_key", base.alias("base"), F.coalesce(F.col("live").cast(short), F.array().cast(short)).alias("live"),
        F.coalesce("base_live", F.lit(0)).alias("base_live"),
        *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_copied", "n_shared", "most_repositories", "most_owners")),
    )
    number = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    every = F.concat("base", "live")
    return out.select(
        "doc_id", *(number(k).alias(f"n_{k}") for k in BASE), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"),
        (F.col("base_live") + F.size("live")).cast("long").alias("n_live"), "n_copied", "n_shared", "most_repositories", "most_owners", "row_key",
        every.alias("all_spans"),
    )


def _row_key(docs: DataFrame) -> Column:
    """128 bits that name the id, text and source of a row."""
    parts = [F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(8), *parts[::-1]).alias("b"))


def _keyed(docs: DataFrame) -> DataFrame:
    text, source = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select(_row_key(docs).alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), source.alias("source"))


def find_secrets(docs: DataFrame, owners: int = COPIED_OWNERS, repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """One row for every row of docs (doc_id, text, source).

    doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, n_shared, most_repositories,
    most_owners, row_key and all_spans (kind, start, end). n_live counts live spans and live base spans, n_copied
    copied base spans, n_shared candidates of either sort that are shared; most_* are the largest counts of the
    row's candidates, 0 without any. A null text has no spans; null doc_ids count as one repository and null
    sources as one owner. Repeated rows stay, and count once. row_key names the row. Other columns are ignored.
    The work on a text grows a little faster than its number of matches.
    """
    return _find(_keyed(docs), owners, repositories)


def _replaced(text: Column, ordered: Column, mark: str) -> Column:
    """The text with ordered spans replaced; blocks of spans each work on their own stretch of the text."""
    width = F.ceil(F.sqrt(F.size(ordered))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(ordered) / width).cast("int") - 1), lambda n: F.slice(ordered, n * width + 1, width))

    def over(state, block):
        reach = F.greatest(F.array_max(F.transform(block, lambda x: x["end"])) - state["at"], F.lit(0))

        def within(part):
            def cut(s, x):
                between = F.substring(part, s["at"] - state["at"] + 1, x["start"] - s["at"])
                out = F.when(x["start"] >= s["at"], F.concat(s["out"], between, F.lit(mark))).otherwise(s["out"])
                return F.struct(F.greatest(s["at"], x["end"]).alias("at"), out.alias("out"))

            return F.aggregate(block, F.struct(state["at"].alias("at"), F.lit("").alias("out")), cut)

        done = _bound(F.substring(text, state["at"] + 1, reach), within)
        return _bound(done, lambda d: F.struct(d["at"].alias("at"), F.concat(state["out"], F.array(d["out"])).alias("out")))

    last = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), over)
    return _bound(last, lambda d: F.concat(F.array_join(d["out"], ""), F.substring(text, d["at"] + 1, F.length(text))))


def redact(docs: DataFrame, mark: str = "[secret]", owners: int = COPIED_OWNERS, repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """docs with every span replaced by `mark`; n_chars, if there, follows the text.

    A span that begins inside another one goes with it. Columns and rows stay, repeated rows and those without
    an id too, whatever their columns are called; texts without spans and null texts are unchanged.
    """
    key, found_spans = tx.free(docs.columns, "_key", "_spans")
    found = find_secrets(docs, owners, repositories).where("spans <> ''").select("row_key", "all_spans").dropDuplicates(["row_key"])
    rows = docs.withColumn(key, _row_key(docs)).join(found.withColumnsRenamed({"row_key": key, "all_spans": found_spans}), key, "left")
    ordered = F.array_sort(F.transform(found_spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))

    some = F.col(found_spans).isNotNull()
    new = F.when(some, _bound(ordered, lambda o: _replaced(F.col("text"), o, mark))).otherwise(F.col("text"))
    columns = {"text": new}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(some, F.length(new).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.select(*(columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in docs.columns))
