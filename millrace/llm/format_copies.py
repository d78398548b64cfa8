"""Records that are the same but for white space, case, punctuation or field order.

A record is a bag of fields (name, value). Names are lower case, values are reduced to their
letters and digits with case folded. Each pair is hashed on its own and the pair hashes are
added, so the fingerprint does not depend on the order of fields and nothing is sorted. Groups
are formed by fingerprint; members are then compared with their group's first record field by
field, counting each pair on both sides. A member that differs from it (a hash collision) is
grouped again by its exact fields, so collisions neither join nor lose records.

Only (fingerprint, id) go through the grouping shuffle, with map-side partial counts, so a group
that holds a third of all rows is one small record per map task. The groups of two or more are
counted; up to `BROADCAST_ROWS` of them are broadcast to find their members, more are joined by
shuffle. Only members travel with their fields, once. A group is spread over one salt for every
`SALT_COPIES` of its records, whatever its size, and its first record is sent to each salt.

Defined cases: null text gives no record; a text that is no readable card is one field of its
own; an empty text is a record with an empty value; a JSON null counts as an empty value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import case_fold
from millrace.plans.checkpoints import cut

CARD_ITEMS = r"\r\n|\n|\r| \| |; "
MASK = (1 << 52) - 1
SALT_COPIES = 20_000
BROADCAST_ROWS = 500_000


def content(value: Column) -> Column:
    """Letters and digits of a value, case folded."""
    return case_fold(F.regexp_replace(F.coalesce(value, F.lit("")), r"[^\p{L}\p{Nd}]+", ""))


def sentence_fields(text: Column) -> Column:
    """A sentence is a record of one field."""
    return F.array(F.struct(F.lit("").alias("name"), content(text).alias("value")))


def card_fields(text: Column) -> Column:
    """Fields of a card stored as a JSON object or as `name: value` items."""
    json_items = F.map_entries(F.from_json(text, "map<string,string>"))
    from_json = F.transform(
        json_items,
        lambda e: F.struct(
            F.lower(F.trim(e["key"])).alias("name"), content(e["value"]).alias("value")
        ),
    )
    items = F.filter(F.split(F.trim(text), CARD_ITEMS), lambda s: F.trim(s) != "")
    from_items = F.transform(
        items,
        lambda s: F.struct(
            F.when(F.instr(s, ":") > 0, F.lower(F.trim(F.substring_index(s, ":", 1))))
            .otherwise(F.lit(""))
            .alias("name"),
            content(
                F.when(
                    F.instr(s, ":") > 0, F.substring(s, F.instr(s, ":") + 1, F.length(s))
                ).otherwise(s)
            ).alias("value"),
        ),
    )
    return F.when(F.ltrim(text).startswith("{"), F.coalesce(from_json, from_items)).otherwise(
        from_items
    )


def fingerprint(fields: Column) -> Column:
    """Order-free hash of a bag of fields: two sums of pair hashes and the number of pairs."""

    def total(seed: str) -> Column:
        hashes = F.transform(
            fields, lambda p: F.xxhash64(F.lit(seed), p["name"], p["value"]).bitwiseAND(F.lit(MASK))
        )
        return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda a, h: (a + h).bitwiseAND(F.lit(MASK)))

    return F.struct(F.size(fields).alias("k"), total("a").alias("a"), total("b").alias("b"))


def same_fields(left: Column, right: Column) -> Column:
    """Bags are equal: every pair occurs as often on both sides."""
    count = lambda bag, p: F.size(F.filter(bag, lambda q: q == p))
    return (F.size(left) == F.size(right)) & F.forall(
        left, lambda p: count(left, p) == count(right, p)
    )


def _records(df: DataFrame, id_col: str, keys: list[str], fields: Column, carry: list[str]) -> DataFrame:
    return df.select(
        F.col(id_col).alias("_id"),
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)],
        fields.alias("_fields"),
    ).where(F.col("_fields").isNotNull())


def _members(marked: DataFrame) -> DataFrame:
    """Records of groups of two or more, with `_first`, `_salts` and their `_salt`; written once."""
    groups = marked.groupBy("_h").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > 1)
    groups = cut(groups.select("_h", "_first", F.ceil(F.col("_copies") / SALT_COPIES).cast("int").alias("_salts")))
    salt = F.pmod(F.xxhash64("_id"), F.col("_salts")).cast("int")
    if groups.count() <= BROADCAST_ROWS:
        return cut(marked.join(F.broadcast(groups), "_h").withColumn("_salt", salt))
    large = cut(groups.where(F.col("_salts") > 1).select("_h", "_salts"))
    large = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
    salted = marked.join(large, "_h", "left").withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_salts")
    spread = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    return cut(salted.join(spread, ["_h", "_salt"]))


def copy_members(df: DataFrame, id_col: str, keys: list[str], fields: Column, carry: list[str] | None = None) -> DataFrame:
    """(keys, carry, first_id, copy_id): each record with the first of its class; firsts stand alone out.

    `fields` gives a record's bag of (name, value). Null keys are keys like any other; `carry` names
    columns of the copies to keep.
    """
    carry = carry or []
    names = [f"_key{i}" for i in range(len(keys))]
    extra = [f"_carry{i}" for i in range(len(carry))]
    records = _records(df, id_col, keys, fields, carry)
    marked = records.withColumn("_h", F.xxhash64(*names, fingerprint(F.col("_fields"))))
    members = _members(marked)
    heads = members.where(F.col("_id") == F.col("_first")).select(
        "_h", F.col("_fields").alias("_head"), *[F.col(n).alias(f"_head{n}") for n in names],
        F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"),
    )
    equal = same_fields(F.col("_fields"), F.col("_head"))
    for n in names:
        equal = equal & F.col(n).eqNullSafe(F.col(f"_head{n}"))
    compared = members.where(F.col("_id") != F.col("_first")).join(heads, ["_h", "_salt"]).withColumn("_equal", equal)
    kept = compared.where("_equal").select(*names, *extra, F.col("_first").alias("first_id"), F.col("_id").alias("copy_id"))
    others = compared.where(~F.col("_equal")).select(
        *names, *extra, "_id", F.array_sort("_fields").alias("_exact")
    )
    regrouped = others.groupBy(*names, "_exact").agg(F.min("_id").alias("_first"))
    rest = (
        others.alias("o")
        .join(
            regrouped.alias("r"),
            [F.col(f"o.{n}").eqNullSafe(F.col(f"r.{n}")) for n in names]
            + [F.col("o._exact") == F.col("r._exact"), F.col("o._id") != F.col("r._first")],
        )
        .select(*[F.col(f"o.{n}") for n in [*names, *extra]], F.col("r._first").alias("first_id"), F.col("o._id").alias("copy_id"))
    )
    out = kept.unionByName(rest)
    named = [F.col(n).alias(k) for n, k in zip([*names, *extra], [*keys, *carry])]
    return out.select(*named, "first_id", "copy_id")


def context_fields(form: Column, text: Column) -> Column:
    """Bag of fields by form; null for forms that are no records and for null texts."""
    return (
        F.when(text.isNull(), None)
        .when(form == "card", card_fields(text))
        .when(form == "sentence", sentence_fields(text))
    )


def context_copies(contexts: DataFrame) -> DataFrame:
    """(first_id, copy_id) over the `sentence` and `card` rows of contexts."""
    rows = contexts.where(F.col("form").isin("sentence", "card"))
    fields = context_fields(F.col("form"), F.col("text"))
    return copy_members(rows, "ctx_id", ["word", "form"], fields).select("first_id", "copy_id")


def collapse_contexts(contexts: DataFrame) -> DataFrame:
    """One row per word, form and content: its first record with `copies` and `total_n`.

    Null `n` counts as 0; `total_n` is null only where every copy's `n` is null.
    """
    rows = contexts.where(F.col("form").isin("sentence", "card") & F.col("text").isNotNull())
    fields = context_fields(F.col("form"), F.col("text"))
    copies = cut(copy_members(rows, "ctx_id", ["word", "form"], fields, ["n"]).select("first_id", "copy_id", "n"))
    more = copies.groupBy(F.col("first_id").alias("ctx_id")).agg(F.count(F.lit(1)).alias("_more"), F.sum("n").alias("_sum"))
    firsts = rows.select("ctx_id", "word", "form", "text", "n").join(copies.select(F.col("copy_id").alias("ctx_id")), "ctx_id", "left_anti")
    out = firsts.join(more, "ctx_id", "left")
    return out.select(
        "ctx_id", "word", "form", "text", (F.coalesce("_more", F.lit(0)) + 1).alias("copies"),
        F.coalesce(F.col("n") + F.col("_sum"), "n", "_sum").alias("total_n"),
    )
