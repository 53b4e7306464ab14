"""Link locations to CRM customers.

A location takes the customer of the first rule that finds one:

1. equal names, preferring an equal address;
2. CRM location name equal to the name;
3. the name inside exactly one CRM name or location name, else exactly one CRM
   name inside the name;
4. the address of exactly one CRM row;
5. for chains, a street number of the name in the address of exactly one CRM
   row of that chain, or, when no address has it, in exactly one CRM name.

One aggregation reduces the CRM rows to one row per lookup key (the lowest and
highest row number, equal when there is a single hit). Joins are then
many-to-one: a name or address shared by very many rows on both sides never
pairs those rows up, and a hot key is split on its many side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.config import MIN_ADDRESS_LENGTH, MIN_NAME_LENGTH, Config
from storeledger.functions.text import is_street_number, norm_key, street_numbers, words
from storeledger.operators.locations import LOCATION_COLUMNS
from storeledger.staging import lookup, materialise

PLACE_KEY = ["norm_name", "norm_addr"]


def with_keys(locations: DataFrame) -> DataFrame:
    return locations.withColumn("norm_name", norm_key(F.col("customer_name"))).withColumn(
        "norm_addr", norm_key(F.col("address"))
    )


def _single(lo: Column, hi: Column) -> Column:
    return F.when(lo == hi, lo)


# --- Rules on whole keys ------------------------------------------------------

# The keys of the CRM, as grouping sets.
NAME, LOCATION_NAME, ADDRESS = ("norm_name",), ("norm_loc",), ("norm_addr",)
PLACE = ("norm_name", "norm_addr")
_KEYS = ("norm_name", "norm_addr", "norm_loc")


def crm_keys(crm: DataFrame) -> DataFrame:
    """Lowest and highest CRM row (``lo``, ``hi``) of every name, location name, address, and
    name with address: one aggregation and one written table for all rules.

    ``kind`` tells the key by the columns it leaves out; those are null.
    """
    grouped = crm.select("ref_ord", *_KEYS).groupingSets(
        [NAME, LOCATION_NAME, ADDRESS, PLACE], *_KEYS
    ).agg(
        F.grouping_id().cast("int").alias("kind"), F.min("ref_ord").alias("lo"),
        F.max("ref_ord").alias("hi"),
    )
    return materialise(grouped, "crm-keys")


def _by(keys: DataFrame, *columns: str) -> DataFrame:
    """Rows of one kind of key: its columns, ``lo`` and ``hi``, without empty keys."""
    kind = sum((name not in columns) << at for at, name in enumerate(reversed(_KEYS)))
    return keys.where((F.col("kind") == kind) & (F.col(columns[0]) != "")).select(
        *columns, "lo", "hi"
    )


def first_by(keys: DataFrame, *columns: str) -> DataFrame:
    """First CRM row of each key."""
    return _by(keys, *columns).select(*columns, F.col("lo").alias("hit"))


def only_by_address(keys: DataFrame) -> DataFrame:
    """The CRM row of each address that a single row has."""
    long_enough = F.length("norm_addr") >= MIN_ADDRESS_LENGTH
    hit = _single(F.col("lo"), F.col("hi"))
    return (
        _by(keys, *ADDRESS).where(long_enough).select("norm_addr", hit.alias("hit"))
        .where(F.col("hit").isNotNull())
    )


def match_exact_name(keyed: DataFrame, crm: DataFrame) -> DataFrame:
    keys = crm_keys(crm)
    same_place = first_by(keys, *PLACE).withColumnRenamed("hit", "place_hit")
    return (
        keyed.join(first_by(keys, *NAME), "norm_name").join(same_place, PLACE_KEY, "left")
        .select("location_code", F.coalesce("place_hit", "hit").alias("hit"))
    )


def match_location_name(keyed: DataFrame, crm: DataFrame) -> DataFrame:
    by_location = first_by(crm_keys(crm), *LOCATION_NAME)
    return keyed.join(
        by_location.withColumnRenamed("norm_loc", "norm_name"), "norm_name"
    ).select("location_code", "hit")


def match_address(keyed: DataFrame, crm: DataFrame) -> DataFrame:
    named = keyed.where(F.col("norm_name") != "")
    return named.join(only_by_address(crm_keys(crm)), "norm_addr").select("location_code", "hit")


# --- Rules on parts of names --------------------------------------------------


def _grams(rows: DataFrame, text: str, *kept: str) -> DataFrame:
    """``kept``, the length of the text as ``size``, and its grams with their places from 1."""
    starts = F.sequence(F.lit(1), F.length(text) - (MIN_NAME_LENGTH - 1))
    grams = F.transform(
        starts,
        lambda at: F.struct(
            at.alias("at"), F.substr(F.col(text), at, F.lit(MIN_NAME_LENGTH)).alias("gram")
        ),
    )
    long_enough = rows.where(F.length(text) >= MIN_NAME_LENGTH)
    return long_enough.select(*kept, F.length(text).alias("size"), F.inline(grams))


def contained(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """Every ``needle`` that a ``text`` of its ``side`` contains, beside the columns of ``texts``.

    An inverted index: each needle is listed under the rarest gram it has, which must occur in
    the texts. What is shuffled of a text are its grams, a few bytes each with a number and a
    place, so the bytes grow with its length; the text itself is joined once, to the places that
    such a gram marks. There it is cut where needles listed under that gram would lie: one cut
    per place in the needle and needle length, however many needles share them. A cut that
    equals a needle is a containment, so no pair is formed only to be rejected.
    """
    key = ["side", "gram"]
    numbered = materialise(texts.withColumn("text_no", F.monotonically_increasing_id()), "texts")
    spots = _grams(numbered, "text", "side", "text_no")
    seen = spots.groupBy(*key).agg(F.count("*").alias("uses"))
    marks = lookup(_grams(needles, "needle", "side", "needle"), seen, key)
    rarest = (
        marks.groupBy("side", "needle", "size")
        .agg(F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "gram", "at")).alias("g"))
        .where("g.uses > 0")  # a gram that no text has: the needle is in none
    )
    cuts = rarest.groupBy("side", "g.gram").agg(
        F.collect_set(F.struct(F.col("g.at").alias("inside"), F.col("size").alias("length")))
        .alias("cuts")
    )
    start = F.col("at") - F.col("cut.inside") + 1
    fits = (start >= 1) & (start + F.col("cut.length") - 1 <= F.col("size"))
    places = (
        lookup(spots, cuts, key, "inner").withColumn("cut", F.explode("cuts")).where(fits)
        .select("text_no", start.alias("start"), F.col("cut.length").alias("length"))
    )
    needle = F.substr(F.col("text"), F.col("start"), F.col("length"))
    return (
        places.join(numbered, "text_no").withColumn("needle", needle)
        .select(*texts.columns, "needle").distinct()
        .join(needles.select("side", "needle"), ["side", "needle"], "left_semi")
    )


# Which side is searched for the names of the other.
IN_CRM, IN_NAME = "in crm", "in name"


def _side(name: str) -> Column:
    return F.lit(name).alias("side")


def _searched_crm(names: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    either = _by(keys, *NAME).toDF("text", "lo", "hi").unionByName(
        _by(keys, *LOCATION_NAME).toDF("text", "lo", "hi")
    )
    texts = either.groupBy("text").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    needles = names.select(_side(IN_CRM), F.col("norm_name").alias("needle")).distinct()
    return texts.select(_side(IN_CRM), "text", "lo", "hi"), needles


def _searched_names(names: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    nothing = F.lit(None).cast("bigint")
    texts = names.select(
        _side(IN_NAME), F.col("norm_name").alias("text"), nothing.alias("lo"), nothing.alias("hi")
    ).distinct()
    return texts, _by(keys, *NAME).select(_side(IN_NAME), F.col("norm_name").alias("needle"))


def _inside(found: DataFrame) -> DataFrame:
    hits = found.where(F.col("side") == IN_CRM).groupBy("needle").agg(
        _single(F.min("lo"), F.max("hi")).alias("hit")
    )
    return hits.where(F.col("hit").isNotNull()).withColumnRenamed("needle", "norm_name")


def _around(found: DataFrame, keys: DataFrame) -> DataFrame:
    owners = _by(keys, *NAME).withColumnRenamed("norm_name", "needle")
    hits = (
        found.where(F.col("side") == IN_NAME).select("text", "needle").join(owners, "needle")
        .groupBy("text").agg(_single(F.min("lo"), F.max("hi")).alias("hit"))
    )
    return hits.where(F.col("hit").isNotNull()).withColumnRenamed("text", "norm_name")


def contains_hits(names: DataFrame, keys: DataFrame) -> DataFrame:
    """(norm_name, hit) of names inside exactly one CRM name or location name."""
    return _inside(contained(*_searched_crm(names, keys)))


def contained_by_hits(names: DataFrame, keys: DataFrame) -> DataFrame:
    """(norm_name, hit) of names that exactly one CRM name is part of."""
    return _around(contained(*_searched_names(names, keys)), keys)


def containment_hits(names: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both of these, from one index over the texts of both sides."""
    sides = zip(_searched_crm(names, keys), _searched_names(names, keys), strict=True)
    texts, needles = (one.unionByName(other) for one, other in sides)
    found = materialise(contained(texts, needles), "contained")
    return _inside(found), _around(found, keys)


def match_contains(keyed: DataFrame, crm: DataFrame) -> DataFrame:
    hits = contains_hits(keyed, crm_keys(crm))
    return lookup(keyed, hits, "norm_name", "inner").select("location_code", "hit")


def match_contained_by(keyed: DataFrame, crm: DataFrame) -> DataFrame:
    hits = contained_by_hits(keyed, crm_keys(crm))
    return lookup(keyed, hits, "norm_name", "inner").select("location_code", "hit")


# --- Rule on street numbers of chains -----------------------------------------


def _chain_numbers(crm: DataFrame, config: Config) -> DataFrame:
    """Lowest and highest CRM row per (chain, street number), for addresses and
    for names. There are at most about 111,000 numbers per chain."""
    chains = F.array_compact(
        F.array(
            *[
                F.when(F.col("norm_name").rlike(pattern), F.lit(chain))
                for chain, pattern in config.chain_name_patterns.items()
            ]
        )
    )

    def numbers(key: str) -> Column:
        found = F.array_distinct(F.filter(words(F.col(key)), is_street_number))
        return F.transform(
            found, lambda n: F.struct(n.alias("number"), F.lit(key).alias("found_in"))
        )

    def in_key(key: str) -> Column:
        return F.when(F.col("found_in") == key, F.col("ref_ord"))

    return (
        crm.select("ref_ord", "norm_name", "norm_addr", F.explode(chains).alias("chain"))
        .select(
            "ref_ord", "chain", F.inline(F.concat(numbers("norm_addr"), numbers("norm_name")))
        )
        .groupBy("chain", "number")
        .agg(
            F.min(in_key("norm_addr")).alias("addr_lo"),
            F.max(in_key("norm_addr")).alias("addr_hi"),
            F.min(in_key("norm_name")).alias("name_lo"),
            F.max(in_key("norm_name")).alias("name_hi"),
        )
    )


def match_street_number(keyed: DataFrame, crm: DataFrame, config: Config) -> DataFrame:
    numbered = keyed.where(F.col("chain").isin(*config.chain_name_patterns)).select(
        "location_code", "chain", F.posexplode(street_numbers(F.col("norm_name")))
    )
    hit = F.when(
        F.col("addr_lo").isNotNull(), _single(F.col("addr_lo"), F.col("addr_hi"))
    ).otherwise(_single(F.col("name_lo"), F.col("name_hi")))
    numbered = numbered.withColumnRenamed("col", "number")
    return (
        lookup(numbered, _chain_numbers(crm, config), ["chain", "number"], "inner")
        .select("location_code", "pos", hit.alias("hit"))
        .where(F.col("hit").isNotNull())
        .groupBy("location_code")
        .agg(F.min_by("hit", "pos").alias("hit"))
    )


# --- Cascade ------------------------------------------------------------------


def with_customer(hits: DataFrame, crm: DataFrame, how: str = "inner") -> DataFrame:
    customer = crm.select(
        F.col("ref_ord").alias("hit"), "crm_customer_id", "crm_customer_name"
    )
    return hits.join(customer, "hit", how)


def resolve(keyed: DataFrame, crm: DataFrame, config: Config) -> DataFrame:
    """Locations with the rule (``step``) and CRM row (``hit``) they match.

    Rules on names run once per distinct name, and the containment rules only
    on the names that the rules before them leave.
    """
    keys = crm_keys(crm)
    by_name = first_by(keys, *NAME).withColumnRenamed("hit", "name_hit")
    by_location = first_by(keys, *LOCATION_NAME).select(
        F.col("norm_loc").alias("norm_name"), F.col("hit").alias("location_hit")
    )
    names = materialise(
        keyed.where(F.col("norm_name") != "")
        .select("norm_name")
        .distinct()
        .join(by_name, "norm_name", "left")
        .join(by_location, "norm_name", "left"),
        "names",
    )
    unnamed = names.where(F.coalesce("name_hit", "location_hit").isNull()).select("norm_name")
    inside, around = containment_hits(unnamed, keys)
    inside = inside.withColumnRenamed("hit", "contains_hit")
    around = around.withColumnRenamed("hit", "contained_hit")
    place = first_by(keys, *PLACE).withColumnRenamed("hit", "place_hit")
    address = only_by_address(keys).withColumnRenamed("hit", "address_hit")
    street = match_street_number(keyed, crm, config).withColumnRenamed("hit", "street_hit")

    named = names.join(inside, "norm_name", "left").join(around, "norm_name", "left")
    candidates = lookup(keyed, named, "norm_name")
    # stored tables with one row per key
    candidates = candidates.join(place, PLACE_KEY, "left").join(address, "norm_addr", "left")
    # one row per location on both sides
    candidates = candidates.join(street, "location_code", "left")
    in_order = (
        F.coalesce("place_hit", "name_hit"), F.col("location_hit"), F.col("contains_hit"),
        F.col("contained_hit"), F.col("address_hit"), F.col("street_hit"),
    )
    step = F.coalesce(
        *[F.when(hit.isNotNull(), F.lit(i)) for i, hit in enumerate(in_order, start=1)]
    )
    named_only = F.col("norm_name") != ""
    return candidates.select(
        *LOCATION_COLUMNS,
        F.when(named_only, step).alias("step"),
        F.when(named_only, F.coalesce(*in_order)).alias("hit"),
    )


def location_map(locations: DataFrame, crm: DataFrame, config: Config) -> DataFrame:
    """Every location with the CRM customer it matches, ``""`` when none."""
    keyed = materialise(with_keys(locations), "locations")
    crm = materialise(crm, "crm")
    resolved = with_customer(resolve(keyed, crm, config), crm, "left")
    return resolved.select(
        *LOCATION_COLUMNS,
        F.coalesce("crm_customer_id", F.lit("")).alias("crm_customer_id"),
        F.coalesce("crm_customer_name", F.lit("")).alias("crm_customer_name"),
    )


def is_mapped() -> Column:
    return F.coalesce(F.btrim("crm_customer_id"), F.lit("")) != ""


def unmapped_locations(location_map: DataFrame) -> DataFrame:
    return location_map.where(~is_mapped())


# --- Overrides entered by hand ------------------------------------------------


def _override_rows(overrides: DataFrame) -> DataFrame:
    """One override per normalised (customer, ship-to), the smallest id first."""
    row = F.struct("crm_customer_id", "crm_customer_name")
    return (
        overrides.select(
            norm_key(F.col("excel_customer")).alias("norm_name"),
            norm_key(F.col("excel_shipto")).alias("norm_addr"),
            row.alias("row"),
        )
        .groupBy("norm_name", "norm_addr")
        .agg(F.min("row").alias("row"))
    )


def customer_overrides(locations: DataFrame, overrides: DataFrame) -> DataFrame:
    """Customer set by hand for a location's name and ship-to address."""
    return (
        lookup(with_keys(locations), _override_rows(overrides), PLACE_KEY, "inner")
        .select("location_code", "row.crm_customer_id", "row.crm_customer_name")
    )


def apply_overrides(location_map: DataFrame, overrides: DataFrame) -> DataFrame:
    """A customer set by hand wins over a matched one."""
    chosen = customer_overrides(location_map, overrides).select(
        "location_code",
        F.col("crm_customer_id").alias("own_id"),
        F.col("crm_customer_name").alias("own_name"),
    )
    own = F.col("own_id").isNotNull()
    return location_map.join(chosen, "location_code", "left").select(
        *LOCATION_COLUMNS,
        F.when(own, F.col("own_id")).otherwise(F.col("crm_customer_id")).alias("crm_customer_id"),
        F.when(own, F.coalesce("own_name", F.lit("")))
        .otherwise(F.col("crm_customer_name"))
        .alias("crm_customer_name"),
    )


def unused_overrides(locations: DataFrame, overrides: DataFrame) -> DataFrame:
    """Overrides that name no known location."""
    known = with_keys(locations).select("norm_name", "norm_addr").distinct()
    known = materialise(known, "known-places")
    keyed = overrides.withColumn("norm_name", norm_key(F.col("excel_customer"))).withColumn(
        "norm_addr", norm_key(F.col("excel_shipto"))
    )
    return keyed.join(known, PLACE_KEY, "left_anti").drop(
        "norm_name", "norm_addr"
    )
