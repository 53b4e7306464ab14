from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from storeledger.config import Config
from storeledger.operators import matching
from storeledger.operators.locations import LOCATION_COLUMNS, location_ref, one_per_location
from storeledger.sources.customers import crm_ref
from tests.conftest import rows

EXPORT = "`Customer Name`, `Customer ID *`, `Location Name`, `Street Address 1 *`, ref_ord bigint"


@pytest.fixture
def crm(spark):
    def make(*customers):
        names = ["Customer Name", "Customer ID *", "Location Name", "Street Address 1 *"]
        schema = ", ".join(f"`{n}` string" for n in names) + ", ref_ord bigint"
        return crm_ref(spark.createDataFrame(
            [(*c, i) for i, c in enumerate(customers)], schema))

    return make


@pytest.fixture
def places(spark):
    def make(*locations):
        """(code, chain, name, address)"""
        full = [(code, chain, name, address, "", "", "") for code, chain, name, address in locations]
        return spark.createDataFrame(full, ", ".join(f"{c} string" for c in LOCATION_COLUMNS))

    return make


def match(locations, crm, config=None):
    mapped = matching.location_map(locations, crm, config or Config())
    return dict(rows(mapped, "location_code", "crm_customer_id"))


def test_crm_rows(crm):
    table = crm(("A", "12.0", None, None), (None, "5", "x", "y"), ("B", "n/a", "L-1", "9 Elm"))
    assert rows(table, "crm_customer_name", "crm_customer_id", "norm_addr", "norm_loc") == [
        ("A", "12", "", ""), ("B", None, "9 ELM", "L 1"),
    ]


def test_equal_name_prefers_equal_address_then_first_row(crm, places):
    table = crm(("Acme #1", "1", None, "1 Elm"), ("ACME 1", "2", None, "2 Oak St"),
                ("acme-1", "3", None, "2 oak st"))
    got = match(places(("x", "distributor", "Acme 1", "2 Oak St."),
                       ("y", "distributor", "Acme 1", "elsewhere")), table)
    assert got == {"x": "2", "y": "1"}


def test_two_empty_addresses_are_equal(crm, places):
    table = crm(("Acme", "1", None, "1 Elm"), ("Acme", "2", None, None))
    assert match(places(("x", "distributor", "Acme", "")), table) == {"x": "2"}


def test_location_name_takes_first_row(crm, places):
    table = crm(("Head", "1", "Shop 9", "a"), ("Head B", "2", "SHOP-9", "b"))
    assert match(places(("x", "distributor", "shop 9", "")), table) == {"x": "1"}


def test_containment_needs_one_hit_and_six_characters(crm, places):
    table = crm(("Big Corner Deli LLC", "1", None, ""), ("The Twins", "2", "Twins East", ""),
                ("Twins East Side", "3", None, ""), ("Abcde Foods", "4", None, ""))
    got = match(places(("one", "distributor", "corner deli", ""),
                       ("two", "distributor", "twins east", ""),
                       ("two hits", "distributor", "Twins E", ""),
                       ("short", "distributor", "abcde", "")), table)
    # "twins east" equals a CRM location name; "TWINS E" is in two rows
    assert got == {"one": "1", "two": "2", "two hits": "", "short": ""}


def test_one_row_holding_the_name_twice_is_one_hit(crm, places):
    table = crm(("Corner Deli One", "1", "Corner Deli Two", ""),)
    assert match(places(("x", "distributor", "Corner Deli", "")), table) == {"x": "1"}


def test_crm_name_inside_the_location_name(crm, places):
    table = crm(("Corner Deli", "1", None, ""), ("Deli", "2", None, ""))
    assert match(places(("x", "distributor", "My Corner Deli Annex", "")), table) == {"x": "1"}
    twice = crm(("Corner Deli", "1", None, ""), ("My Corner", "2", None, ""))
    assert match(places(("x", "distributor", "My Corner Deli Annex", "")), twice) == {"x": ""}


def test_ambiguous_containment_falls_through_to_the_address(crm, places):
    table = crm(("Corner Deli A", "1", None, "77 Long Road"), ("Corner Deli B", "2", None, "x"))
    assert match(places(("x", "distributor", "Corner Deli", "77 long road")), table) == {"x": "1"}


def test_address_needs_one_hit_and_eight_characters(crm, places):
    table = crm(("A", "1", None, "9 Elm St"), ("B", "2", None, "9 Elm"),
                ("C", "3", None, "10 Same Street"), ("D", "4", None, "10 same street"))
    got = match(places(("one", "distributor", "zz", "9 elm st"), ("short", "distributor", "zz", "9 elm"),
                       ("two", "distributor", "zz", "10 Same Street"),
                       ("no name", "distributor", "", "9 Elm St")), table)
    assert got == {"one": "1", "short": "", "two": "", "no name": ""}


def test_street_numbers_of_chains(crm, places):
    table = crm(
        ("LPQ Bakery East", "1", None, "8431 Linden Way"), ("LPQ Bakery 555", "2", None, "Main Road"),
        ("LPQ Bakery West", "3", None, "900 Pine"), ("LPQ Bakery North", "4", None, "900 Oak"),
        ("Other 8431", "5", None, "8431 Other"), ("JTJ One", "6", None, "321 Elm"),
    )
    got = match(places(
        ("addr", "chain_a", "PAIN 8431 LINDEN WY", ""), ("name", "chain_a", "PAIN 555", ""),
        ("next", "chain_a", "PAIN 900 8431", ""), ("year", "chain_a", "PAIN 1999 X 8431", ""),
        ("many", "chain_a", "PAIN 900", ""), ("chain b", "chain_b", "JOE 321", ""),
        ("wrong chain", "chain_b", "JOE 8431", ""), ("no chain", "distributor", "PAIN 8431", ""),
    ), table)
    assert got == {"addr": "1", "name": "2", "next": "1", "year": "1", "many": "", "chain b": "6",
                   "wrong chain": "", "no chain": ""}


def test_bad_crm_id_is_unmapped(crm, places):
    mapped = matching.location_map(places(("x", "distributor", "Acme", "")),
                                   crm(("Acme", "pending", None, "")), Config())
    assert rows(matching.unmapped_locations(mapped), "location_code", "crm_customer_name") == [
        ("x", "Acme")
    ]


# --- Against a plain search over all rows -------------------------------------


def key(text):
    return re.sub("[^A-Z0-9]+", " ", (text or "").upper()).strip()


def search(code, chain, name, address, customers):
    """First matching customer by looking at every CRM row for every rule."""
    name, address = key(name), key(address)
    table = [(key(n), key(loc), key(a), cid) for n, cid, loc, a in customers]
    if not name:
        return ""
    same = [r for r in table if r[0] == name]
    if same:
        return next((r for r in same if r[2] == address), same[0])[3]
    for r in table:
        if r[1] == name:
            return r[3]
    rules = []
    if len(name) >= 6:
        rules.append([r for r in table if name in r[0] or name in r[1]])
        rules.append([r for r in table if len(r[0]) >= 6 and r[0] in name])
    if len(address) >= 8:
        rules.append([r for r in table if r[2] == address])
    for hits in rules:
        if len(hits) == 1:
            return hits[0][3]
    pattern = Config().chain_name_patterns.get(chain)
    if pattern:
        mine = [r for r in table if re.search(pattern, r[0])]
        for word in name.split():
            if not re.fullmatch("[0-9]{3,5}", word) or int(word) >= 10000:
                continue
            if 1900 <= int(word) <= 2030:
                continue
            by_address = [r for r in mine if word in r[2].split()]
            by_name = [r for r in mine if word in r[0].split()]
            hits = by_address or by_name
            if len(hits) == 1:
                return hits[0][3]
    return ""


@pytest.mark.parametrize("seed", range(4))
def test_cascade_equals_plain_search(seed, crm, places):
    rng = random.Random(seed)
    words = ["LPQ", "JTJ", "PAIN", "CORNER", "DELI", "EAST", "100", "555", "8431", "1999", "THE"]

    def phrase(low, high):
        return " ".join(rng.choices(words, k=rng.randint(low, high)))

    customers = [
        (phrase(1, 4), str(i), rng.choice([None, phrase(1, 3)]), rng.choice([None, phrase(1, 3)]))
        for i in range(60)
    ]
    locations = [
        (f"L{i}", rng.choice(["distributor", "chain_a", "chain_b"]), phrase(0, 4), phrase(0, 3))
        for i in range(250)
    ]
    expected = {loc[0]: search(*loc, customers) for loc in locations}
    assert match(places(*locations), crm(*customers)) == expected
    assert len(set(expected.values())) > 10


def test_containment_equals_nested_loop(spark, crm):
    rng = random.Random(9)
    names = sorted({"".join(rng.choices("AB ", k=rng.randint(4, 12))).strip() for _ in range(300)})
    names = [n for n in map(key, names) if n]
    table = crm(*[(n, str(i), None, "") for i, n in enumerate(names[::2])])
    keyed = spark.createDataFrame([(n,) for n in names[1::2]], "norm_name string")
    refs = list(enumerate(names[::2]))

    def single(test):
        hits = {}
        for n in set(names[1::2]):
            found = [i for i, c in refs if test(n, c)]
            if len(found) == 1:
                hits[n] = found[0]
        return hits

    inside = single(lambda n, c: len(n) >= 6 and n in c)
    around = single(lambda n, c: len(c) >= 6 and c in n)
    keys = matching.crm_keys(table)
    assert dict(rows(matching.contains_hits(keyed, keys), "norm_name", "hit")) == inside
    assert dict(rows(matching.contained_by_hits(keyed, keys), "norm_name", "hit")) == around
    both = [dict(rows(hits, "norm_name", "hit")) for hits in matching.containment_hits(keyed, keys)]
    assert both == [inside, around]
    assert inside and around


# --- Reference rows, overrides ------------------------------------------------


def test_location_ref_takes_most_frequent_then_smallest(spark):
    cells = spark.createDataFrame(
        [
            ("chain_b", "X", "Shop", "1 Elm", None, "NY", "1", 2),
            ("distributor", "X", "Zed", "2 Oak", None, "NY", "2", 2),
            ("chain_a", "X", "Shop", "", None, None, "2", 1),
            ("distributor", None, "Lost", "", None, None, None, 9),
        ],
        "source string, location_code string, customer_name string, address string,"
        " city string, state string, zip string, lines bigint",
    )
    assert rows(location_ref(cells)) == [("X", "distributor", "Shop", "1 Elm", "", "NY", "2")]


def test_repeated_codes_in_a_saved_map(frame):
    saved = frame("location_code, chain", [("A", "x"), ("A", "b"), ("B", "c")])
    assert rows(one_per_location(saved)) == [("A", "b"), ("B", "c")]


def test_overrides_win_and_leftovers_are_listed(frame, crm, places):
    locations = places(("x", "distributor", "Acme", "1 Elm"), ("y", "distributor", "Acme", "2 Oak"))
    mapped = matching.location_map(locations, crm(("Acme", "1", None, "")), Config())
    manual = frame("excel_customer, excel_shipto, crm_customer_id, crm_customer_name",
                   [("ACME’S".replace("’S", ""), "2 OAK", "99", "Acme Oak"), ("Zed", "q", "5", "Zed")])
    applied = matching.apply_overrides(mapped, manual)
    assert rows(applied, "location_code", "crm_customer_id") == [("x", "1"), ("y", "99")]
    assert rows(matching.unused_overrides(locations, manual), "excel_customer") == [("Zed",)]
    assert applied.where(F.col("crm_customer_name") == "Acme Oak").count() == 1
