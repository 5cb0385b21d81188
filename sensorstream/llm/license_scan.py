"""License scans: sentences to identifiers, identifier sequences against ordered rules.

A text is cut into sentences (at line ends and after a full stop, question or
exclamation mark before white space); sentences are normalised to lower-case
ASCII letters and digits with single blanks between them. A known sentence is
found where its normal form is that of one sentence or of several that follow
each other, blank ones aside: lines wrapped anywhere, comment marks and full
stops inside it do not matter. Known license sentences carry identifiers; a
rule is a license and the ordered identifiers that state it. A rule matches where its identifiers follow each other among
the text's recognised sentences with nothing known between them; longer rules
win over rules whose match lies inside theirs.

Everything is DataFrame operations. Sentences that are not known are dropped
before any shuffle: the table of known sentences is a fixed list, so it is
broadcast whatever the input. Only recognised sentences are grouped, and a
text's matches are found inside the rows of that text.

Defined results: a text (or null, or empty) without a known sentence gives no
row; repeated sentences match each time and the spans list every match in
order; a known sentence inside a longer known one is part of that one; equal
rows are reported each; a null id is reported as null; an empty
table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import let, session, text_of

# Sentences of public licenses and notices, each with its identifier.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-may-not": "You may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mit-notice": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
}
# The Creative Commons 4.0 licenses that add to CC BY, by code and by name.
_CC = {
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
SENTENCES |= {f"cc-{c.lower()}-notice": f"This work is licensed under a Creative Commons {name} 4.0 International License." for c, name in _CC.items()}
SENTENCES |= {f"cc-{c.lower()}-short": f"Licensed under CC {c} 4.0." for c in ("BY", *_CC)}
# Rules, as (license, identifiers in order).
RULES = [
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-notice", "apache-may-not", "apache-copy"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-warranty"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("BSD-2-Clause", ["bsd-redistribution"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-endorse"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("All-Rights-Reserved", ["all-rights-reserved"]),
    ("CC-BY-4.0", ["cc-by-short"]),
    *((f"CC-{c}-4.0", [f"cc-{c.lower()}-{form}"]) for c in _CC for form in ("notice", "short")),
]


#: Ends of sentences: a line feed, or white space after a full stop, question or exclamation mark.
ENDS = r"\n|(?<=[.!?])[ \t\r]+"


def sentences(text: Column) -> Column:
    """The text's sentences, normalised, in order (array)."""
    lines = F.translate(F.regexp_replace(text, ENDS, "\n"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(F.regexp_replace(F.regexp_replace(lines, r"[^a-z0-9\n]+", " "), "(?m)^ | $", ""), "\n")


def _normal_form(text: str) -> str:
    """The normalised sentences of a listed text, one after the other."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.sub("[^a-z0-9]+", " ", low).strip()


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    table: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None,
) -> DataFrame:
    """One row per text with a match: id, licenses (sorted, distinct), spans (license, first and last sentence number)."""
    spark = session(docs)
    table, rules = SENTENCES if table is None else table, RULES if rules is None else rules
    forms = {name: form for name, text in table.items() if (form := _normal_form(text))}
    # a known sentence is told by its normal form, so entries of one form are one sentence; rules of one sequence are one rule
    sequences: dict[tuple[str, ...], set[str]] = {}
    for license_, ids in rules:
        if all(i in forms for i in ids):
            sequences.setdefault(tuple(forms[i] for i in ids), set()).add(license_)
    most = max((form.count(" ") + 1 for form in forms.values()), default=1)  # a sentence has a word at least
    known = spark.createDataFrame([(form.split(" ")[0], form) for form in sorted(set(forms.values()))], "first string, norm string")
    # a known sentence may go on over the next ones (wrapped lines, a full stop inside it): as many as have its words in all
    begins = sorted({" ".join(form.split(" ")[: k + 1]) for form in forms.values() for k in range(form.count(" ") + 1)})
    full = F.filter(F.transform(sentences(text_of(text_col)), lambda n, at: F.struct(at.alias("at"), n.alias("n"))), lambda s: s["n"] != "")
    starts = let(full, lambda all_: F.filter(
        F.transform(all_, lambda s, k: F.when(s["n"].isin(begins), F.struct(k.alias("pos"), F.slice(all_, k + 1, most).alias("next")))),
        lambda c: c.isNotNull(),
    ))
    # numbered before the explode: in one select, Spark would number the exploded rows
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), starts.alias("starts"))
    rows = rows.select("rid", "id", F.explode("starts").alias("c")).select("rid", "id", "c.*")
    rows = rows.join(F.broadcast(known), F.substring_index(F.col("next")[0]["n"], " ", 1) == F.col("first"))
    rows = rows.where(F.startswith(F.array_join(F.col("next")["n"], " "), "norm"))
    whole = F.filter(F.sequence(F.lit(1), F.size("next")), lambda m: F.array_join(F.slice(F.col("next")["n"], F.lit(1), m), " ") == F.col("norm"))
    rows = rows.select("rid", "id", "pos", "norm", "next", F.get(whole, F.lit(0)).alias("m"))
    rows = rows.where("m is not null").select("rid", "id", "pos", "m", F.col("norm").alias("sid"), F.col("next")[0]["at"].alias("at"), F.get("next", F.col("m") - 1)["at"].alias("end"))
    # a known sentence inside a longer one is part of that one
    found = _not_inside(rows, "pos")
    # sentences in order, with their number among the text's recognised ones
    order = W.partitionBy("rid").orderBy("pos")
    longest = max((len(ids) for ids in sequences), default=1)
    ahead = F.array(*(F.lead("sid", k).over(order) for k in range(longest)))
    last = F.array(*(F.lead("end", k).over(order) for k in range(longest)))
    here = found.select("rid", "id", "at", F.row_number().over(order).alias("k"), ahead.alias("ahead"), last.alias("ends"))
    ruled = spark.createDataFrame([(sorted(names), list(ids), len(ids), ids[0]) for ids, names in sequences.items()], "names array<string>, ids array<string>, m int, head string")
    hits = here.join(F.broadcast(ruled), F.col("ahead")[0] == F.col("head")).where(F.slice("ahead", 1, F.col("m")) == F.col("ids"))
    hits = hits.select("rid", "id", "at", "k", "names", "m", F.element_at("ends", F.col("m")).alias("end"))
    # a match inside a longer one that starts at or before it is dropped
    return _not_inside(hits, "k").select("rid", "id", "at", "end", F.explode("names").alias("license")).groupBy("rid").agg(
        F.first("id").alias("id"),
        F.array_sort(F.collect_set("license")).alias("licenses"),
        F.array_sort(F.collect_list(F.struct("at", "end", "license"))).alias("spans"),
    ).drop("rid")


def _not_inside(rows: DataFrame, start: str) -> DataFrame:
    """Rows (``m`` long from ``start``) that do not lie inside another row of their text."""
    reach = W.partitionBy("rid").orderBy(start, F.desc("m")).rowsBetween(W.unboundedPreceding, -1)
    end = F.col(start) + F.col("m")
    return rows.withColumn("covered", F.coalesce(F.max(end).over(reach) >= end, F.lit(False))).where("not covered").drop("covered")
