"""Ordered lists: first occurrence wins, capped; folds and unions that keep what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlake.functions.normalize import collapse, norm_key


def clean_list(values: Column, cap: int | None = 40) -> Column:
    """Collapsed, non-blank, distinct in order of first occurrence, at most ``cap`` (None: all)."""
    cleaned = F.array_distinct(F.filter(F.transform(values, lambda v: collapse(v)), lambda v: F.coalesce(v, F.lit("")) != ""))
    return cleaned if cap is None else F.slice(cleaned, 1, cap)


def ordered_lists(df: DataFrame, keys: list[str], value: Column, *order: Column, cap: int = 40, out: str = "values") -> DataFrame:
    """Per key its values in order, cleaned as ``clean_list``, where a key may have any number of rows.

    Each (key, value) is reduced to its first place by a partial aggregate, and a key's values are
    cut to the first ``cap`` before they are collected, so no list is longer than that.
    """
    clean = F.coalesce(collapse(value), F.lit(""))
    places = df.select(*keys, clean.alias("__v"), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("__o")).groupBy(*keys, "__v").agg(F.min("__o").alias("__o"))
    first = places.filter("__v <> ''").withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("__o", "__v"))).filter(F.col("__n") <= cap)
    lists = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", "__v"))), lambda r: r["__v"]).alias(out))
    return places.select(*keys).distinct().join(lists.hint("merge"), keys, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def ordered_words(df: DataFrame, keys: list[str], value: Column, *order: Column, cap: int = 40, out: str = "values") -> DataFrame:
    """As ``ordered_lists`` for words that are one if their normalized keys are; the form named first stays."""
    places = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], collapse(value).alias("v"))
    rows = df.select(*keys, norm_key(value).alias("__k"), places.alias("__o")).filter("__k <> ''").groupBy(*keys, "__k").agg(F.min("__o").alias("__o"))
    first = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("__o", "__k"))).filter(F.col("__n") <= cap)
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", F.col("__o.v").alias("v")))), lambda r: r["v"]).alias(out))


def collect_ordered(value: Column, *order: Column, cap: int = 40) -> Column:
    """Aggregate: the group's values in order, cleaned as ``clean_list``."""
    rows = F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], value.alias("v"))))
    return clean_list(F.transform(rows, lambda r: r["v"]), cap)


def fold_text(values: Column) -> Column:
    """Left fold of texts: each step collapses what is there to one line and adds a line unless equal.

    Only the line's length is carried along: it is put together where a text is as long as it, and in
    the end, so that the work grows with the texts and not with their square.
    """
    none, space = F.lit(""), F.lit(" ")
    let = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))

    def fold(texts: Column) -> Column:
        # what is held: the line of the first ``upto`` texts, texts seen, bytes of the whole line, whether the last text was added to a line
        state = lambda line, upto, seen, size, added: F.struct(line.alias("line"), upto.alias("upto"), seen.alias("seen"), size.alias("size"), added.alias("added"))
        no, yes = F.lit(False), F.lit(True)

        def whole(s: Column, seen: Column) -> Column:
            rest = F.filter(F.slice(texts, s["upto"] + 1, F.greatest(seen - s["upto"], F.lit(0))), lambda x: x != "")
            return F.when(F.size(rest) == 0, s["line"]).when(s["line"] == "", F.array_join(rest, " ")).otherwise(F.concat(s["line"], space, F.array_join(rest, " ")))

        def step(s: Column, item: Column) -> Column:
            seen, more = s["seen"] + 1, s["size"] + 1 + F.octet_length(item)
            line = F.when(s["size"] == F.octet_length(s["line"]), s["line"]).otherwise(whole(s, s["seen"]))
            compared = let(line, lambda a: F.when(a == item, state(a, seen, seen, s["size"], no)).otherwise(state(a, s["seen"], seen, more, yes)))
            return (
                F.when(item == "", state(s["line"], s["upto"], seen, s["size"], no))
                .when(s["size"] == 0, state(none, s["upto"], seen, F.octet_length(item), no))
                .when(s["size"] == F.octet_length(item), compared)
                .otherwise(state(s["line"], s["upto"], seen, more, yes))
            )

        done = lambda s: F.when(s["added"], F.concat(whole(s, s["seen"] - 1), F.lit("\n"), F.element_at(texts, s["seen"]))).otherwise(whole(s, s["seen"]))
        return F.aggregate(texts, state(none, F.lit(0), F.lit(0), F.lit(0), no), step, done)

    return let(F.transform(values, lambda v: F.coalesce(collapse(v), none)), fold)


def first_non_empty(value: Column, *order: Column) -> Column:
    """Aggregate: the first value in order that is not blank."""
    return F.min_by(value, F.when(F.coalesce(F.trim(value), F.lit("")) != "", F.struct(*order)))


def append_capped(old: Column, new: Column, cap: int | Column = 40, forbidden: Column | None = None, key=lambda v: v) -> Column:  # noqa: ANN001
    """The old list as it is, then new values not yet there (by ``key``) while there is room."""
    old = F.coalesce(old, F.array().cast("array<string>"))
    known = F.transform(old, key)
    if forbidden is not None:
        known = F.concat(known, forbidden)
    fresh = F.filter(F.coalesce(new, F.array().cast("array<string>")), lambda v: (F.coalesce(v, F.lit("")) != "") & ~F.array_contains(known, key(v)))
    by_key = F.transform(F.array_distinct(F.transform(fresh, key)), lambda k: F.element_at(F.filter(fresh, lambda v: key(v) == k), 1))
    cap = F.lit(cap) if isinstance(cap, int) else cap
    return F.concat(old, F.slice(by_key, F.lit(1), F.greatest(cap - F.size(old), F.lit(0))))


def merge_named(old: Column, new: Column, cap: int = 40, longest: bool = True) -> Column:
    """Union of (word, definition) lists by lower-cased word; the longer definition wins, or the first."""
    items = F.filter(
        F.transform(F.concat(old, new), lambda e: F.struct(collapse(e["word"]).alias("word"), collapse(e["definition"]).alias("definition"))),
        lambda e: (F.coalesce(e["word"], F.lit("")) != "") & (F.coalesce(e["definition"], F.lit("")) != ""),
    )
    keys = F.slice(F.array_distinct(F.transform(items, lambda e: F.lower(e["word"]))), 1, cap)

    def pick(k: Column) -> Column:
        same = F.filter(items, lambda e: F.lower(e["word"]) == k)
        first = F.element_at(same, 1)
        if not longest:
            return first
        best = F.aggregate(same, first["definition"], lambda a, e: F.when(F.length(e["definition"]) > F.length(a), e["definition"]).otherwise(a))
        return F.struct(first["word"].alias("word"), best.alias("definition"))

    return F.transform(keys, pick)
