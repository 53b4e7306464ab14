"""License scans: MinHash bands over text windows, then exact containment.

Texts are cut into overlapping windows about as long as a template. A window becomes a candidate
when the smallest hash of its shingles under one of ten hash functions equals the template's
(ten bands of one row). A window that holds the whole template has a Jaccard similarity of 0.8
or more with it, and meets in some band with probability above 0.999999; one that holds just the
share asked for has 0.55 or more, and meets with 0.9996 or more. Templates of up to four shingles
cannot miss one: their windows are single shingles, and the probability is 1. So are those of
fewer than five words, which are one shingle of all their words. Documents with a candidate are
then compared exactly, window by window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import ascii_lower, let, named, whole

# --- Fixed values: notices and paragraphs of public licenses ---
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-notice":
        "This work is licensed under the GNU General Public License, version 3.",
    "mit-notice": "Released under the MIT License.",
    "mit-permission":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the"
        " Software without restriction, including without limitation the rights to use, copy,"
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
        " and to permit persons to whom the Software is furnished to do so, subject to the"
        " following conditions:",
    "apache-2.0-header":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or"
        " agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or"
        " implied.",
}
# More of them.
MORE_TEMPLATES = {
    "agpl-header":
        "under the terms of the GNU Affero General Public License as published by the Free"
        " Software Foundation",
    "bsd-disclaimer":
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY"
        " EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES"
        " OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "bsd-redistribution":
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met:",
    "bsl-1.0-permission":
        "Permission is hereby granted, free of charge, to any person or organization obtaining"
        " a copy of the software and accompanying documentation covered by this license",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-4.0-statement":
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-statement":
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License.",
    "cc-by-sa-4.0-statement":
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0"
        " International License.",
    "epl-header":
        "This program and the accompanying materials are made available under the terms of the"
        " Eclipse Public License",
    "gnu-version-2-or-later":
        "either version 2 of the License, or (at your option) any later version",
    "gnu-version-2.1-or-later":
        "either version 2.1 of the License, or (at your option) any later version",
    "gnu-version-3-or-later":
        "either version 3 of the License, or (at your option) any later version",
    "gpl-header":
        "under the terms of the GNU General Public License as published by the Free Software"
        " Foundation",
    "gpl-2.0-only-header":
        "under the terms of the GNU General Public License version 2 as published by the Free"
        " Software Foundation",
    "isc-permission":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with"
        " or without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    "lgpl-header":
        "under the terms of the GNU Lesser General Public License as published by the Free"
        " Software Foundation",
    "mpl-2.0-header":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If"
        " a copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/.",
    "unlicense-notice":
        "This is free and unencumbered software released into the public domain.",
    "zlib-disclaimer":
        "This software is provided 'as-is', without any express or implied warranty. In no event"
        " will the authors be held liable for any damages arising from the use of this software.",
}
# Notices of fewer words than a shingle has.
SHORT_TEMPLATES = {"all-rights-reserved": "All rights reserved."}
WIDTH = 5  # words of a shingle
CONTAINED = 0.8
_BANDS = 10
_SHORT = 4  # templates of which no shingle may be missing
_WORD = r"[\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(_WORD), F.lit(0))


@dataclass(frozen=True)
class Template:
    name: str
    shingles: tuple[str, ...]
    width: int = WIDTH  # words of a shingle

    @property
    def stride(self) -> int:
        return max(1, len(self.shingles) // 4)

    @property
    def window(self) -> int:
        """Shingles of a window: any occurrence lies within one."""
        return len(self.shingles) + self.stride - 1


def _template_words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\W_]+", text.lower())


def template(name: str, text: str, width: int = WIDTH) -> Template:
    found = _template_words(text)
    if len(found) < width:
        raise ValueError(f"template {name} has fewer than {width} words")
    shingles = (" ".join(found[i : i + width]) for i in range(len(found) - width + 1))
    return Template(name, tuple(dict.fromkeys(shingles)), width)


def any_template(name: str, text: str) -> Template:
    """A template of at least one word; of fewer than ``WIDTH`` words, one shingle of them all."""
    return template(name, text, max(1, min(WIDTH, len(_template_words(text)))))


def _classes(templates: Sequence[Template]) -> dict[tuple[int, int], list[Template]]:
    """Templates by window and stride of the search; the short ones by single shingles."""
    found: dict[tuple[int, int], list[Template]] = {}
    for t in templates:
        size = (1, 1) if len(t.shingles) <= _SHORT else (t.window, t.stride)
        found.setdefault(size, []).append(t)
    return found


def _starts(count: Column, window: int, stride: int) -> Column:
    """Starts of the windows over so many shingles; the last may be shorter."""
    last = F.greatest(count - window + stride - 1, F.lit(0))
    return F.sequence(F.lit(0), last, F.lit(stride))


def _mixed(hashes: Column, band: int) -> Column:
    """Shingle hashes under the hash function of a band."""
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band)))


def _smallest(mixed: Column, window: int, stride: int) -> Column:
    """The smallest hash of each window."""
    if window == 1:
        return mixed
    return F.transform(
        _starts(F.size(mixed), window, stride),
        lambda i: F.array_min(F.slice(mixed, i + 1, window)),
    )


def _band_values(spark, templates: Sequence[Template]) -> dict[str, list]:
    """Per template and band its smallest hash, and the hash of the shingle it comes from; by
    Spark's own hash function."""
    rows = spark.createDataFrame([(t.name, list(t.shingles)) for t in templates],
                                 "name string, shingles array<string>")
    searched = F.when(F.size("shingles") <= _SHORT, F.slice("shingles", 1, 1)).otherwise(
        F.col("shingles")
    )
    hashes = F.flatten(F.transform(searched, lambda s: _hashes(F.split(s, " "))))
    smallest = [
        F.array_min(F.arrays_zip(_mixed(hashes, b).alias("value"), hashes.alias("shingle")))
        for b in range(_BANDS)
    ]
    return {r[0]: r[1] for r in rows.select("name", F.array(*smallest)).collect()}


def _any(parts: Sequence[Column]) -> Column:
    found = parts[0]
    for part in parts[1:]:
        found = found | part
    return found


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingle_hashes(hashes: Column, width: int) -> Column:
    """Shingle hashes of a list of word hashes, none if it is shorter than a shingle."""
    starts = F.sequence(F.lit(0), F.size(hashes) - width)
    full = F.transform(
        starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)])
    )
    return F.when(F.size(hashes) >= width, full).otherwise(F.array().cast("array<bigint>"))


def _hashes(words: Column) -> Column:
    return let(_word_hashes(words), lambda hashes: _shingle_hashes(hashes, WIDTH))


def candidates(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Rows ``doc_id, text`` in which a band retrieves a template."""
    long = [t for t in templates if t.width == WIDTH]
    short = [t for t in templates if t.width < WIDTH]
    values = _band_values(docs.sparkSession, long) if long else {}

    def agrees(hashes: Column, band: int) -> Column:
        """Whether any window agrees with a template of its class in this band."""

        def of(mixed: Column) -> Column:
            return _any([
                F.arrays_overlap(
                    _smallest(mixed, *size),
                    F.array(*[F.lit(values[t.name][band]["value"]) for t in own]),
                )
                for size, own in _classes(long).items()
                if size != (1, 1) or band == 0  # equal hashes are equal under any function
            ])

        return let(_mixed(hashes, band), of)

    sources = sorted({band["shingle"] for bands in values.values() for band in bands})

    def retrieved(hashes: Column) -> Column:
        # a window can only meet a band's value if it holds the shingle that has it: in most
        # documents there is none, and no window needs to be looked at
        met = F.arrays_overlap(hashes, F.array(*map(F.lit, sources)))
        return met & _any([agrees(hashes, b) for b in range(_BANDS)])

    def holds(width: int, hashes: Column) -> Column:
        """Whether the text holds a template of so many words."""
        own = [
            F.xxhash64(*[F.xxhash64(F.lit(w)) for w in t.shingles[0].split(" ")])
            for t in short if t.width == width
        ]
        return F.arrays_overlap(_shingle_hashes(hashes, width), F.array(*own))

    def any_retrieved(hashes: Column) -> Column:
        parts = [let(_shingle_hashes(hashes, WIDTH), retrieved)] if long else []
        parts += [holds(width, hashes) for width in sorted({t.width for t in short})]
        return _any(parts) if parts else F.lit(False)

    return docs.where(let(_word_hashes(_words(F.col("text"))), any_retrieved))


def _matches(found: Column, t: Template) -> Column:
    """Windows that contain the template: array of (first word, share of its shingles)."""
    own = F.array(*[F.lit(s) for s in t.shingles])
    size = len(t.shingles)

    def window(i: Column) -> Column:
        shared = F.size(F.array_intersect(F.slice(found, i + 1, t.window), own))
        return F.struct(i.cast("long").alias("first_word"), (shared / size).alias("share"))

    every = F.transform(_starts(F.size(found), t.window, t.stride), window)
    return F.filter(every, lambda w: w["share"] >= CONTAINED)


def matched(rows: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Every window of ``doc_id, text`` against every template, without bands."""

    def shingled(words: Column, width: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - width)
        full = F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, width), " "))
        return F.when(F.size(words) >= width, full).otherwise(F.array().cast("array<string>"))

    def compared(words: Column, width: int) -> Column:
        own = [t for t in templates if t.width == width]
        return let(shingled(words, width), lambda shingles: F.array(*[
            F.struct(F.lit(t.name).alias("license"), _matches(shingles, t).alias("windows"))
            for t in own
        ]))

    def every(words: Column) -> Column:
        widths = sorted({t.width for t in templates})
        return F.concat(*[compared(words, width) for width in widths])

    found = let(_words(F.col("text")), every)
    return (
        rows.select("doc_id", F.inline(found))
        .where(F.size("windows") > 0)
        .select(
            "doc_id", "license",
            F.array_max(F.transform("windows", lambda w: w["share"])).alias("containment"),
            F.size("windows").cast("long").alias("n_windows"),
            F.get("windows", F.lit(0))["first_word"].alias("first_word"),
        )
    )


def scan(
    docs: DataFrame,
    texts: Mapping[str, str] = TEMPLATES | MORE_TEMPLATES | SHORT_TEMPLATES,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Licenses found in documents.

    Words are runs of letters and digits, A to Z lower-cased. A template is found when a window
    of the text holds at least 0.8 of its distinct shingles of five words; one of fewer than five
    words where all of them follow each other. Returns ``doc_id, license, containment`` (of the
    best window), ``n_windows`` (windows that contain it) and ``first_word`` (start of the first
    one). Texts that are null or empty have none; rows that repeat a document each give their
    rows; an empty table none.
    """
    templates = [any_template(name, text) for name, text in texts.items()]
    rows = docs.select(named(id_column).alias("doc_id"), whole(named(text_column)).alias("text"))
    return matched(candidates(rows, templates), templates)


def oracle_sql(texts: Mapping[str, str] = TEMPLATES | MORE_TEMPLATES | SHORT_TEMPLATES) -> str:
    """The same without bands: every window of every document against every template."""
    templates = [any_template(name, text) for name, text in texts.items()]
    listed = ", ".join(
        f"('{t.name}', {t.width}, {len(t.shingles)}, {t.window}, {t.stride}, {list(t.shingles)})"
        for t in templates
    )
    return f"""
        WITH template(license, width, size, span, stride, shingles) AS (VALUES {listed}),
        worded AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\p{{L}}\\p{{N}}]+') AS words
            FROM documents
        ), started AS (
            SELECT doc_id, words, width, len(words) - width + 1 AS n,
                   unnest(generate_series(1, len(words) - width + 1)) AS i
            FROM worded JOIN (SELECT DISTINCT width FROM template) w ON len(words) >= width
        ), shingled AS (
            SELECT doc_id, width, n, i - 1 AS place,
                   array_to_string(list_slice(words, i, i + width - 1), ' ') AS shingle
            FROM started
        ), hit AS (
            SELECT doc_id, n, license, size, span, stride, place, shingle
            FROM shingled s JOIN (SELECT *, unnest(shingles) AS own FROM template) t
              ON shingle = own AND s.width = t.width
        ), placed AS (
            SELECT *, unnest(generate_series(
                greatest(0, (place - span + stride) // stride) * stride, place, stride)) AS start
            FROM hit
        ), windowed AS (
            SELECT doc_id, license, start, count(DISTINCT shingle) / size AS share
            FROM placed
            WHERE start <= place AND place < start + span
              AND start <= greatest(n - span + stride - 1, 0)
            GROUP BY doc_id, license, start, size
        )
        SELECT doc_id, license, max(share) AS containment, count(*) AS n_windows,
               min(start) AS first_word
        FROM windowed WHERE share >= {CONTAINED} GROUP BY doc_id, license
    """
