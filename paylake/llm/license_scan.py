"""Licence recognition by sentence rules, in DataFrame expressions only.

A text is cut into sentences (at full stops, question and exclamation marks and
semicolons before white space, and at empty lines; a sentence may run over line
ends).  Sentences are normalised and mapped to identifiers of known licence
sentences; the sequence of identifiers of a text is matched against ordered
licence rules, each of which takes its sentences out, so that a full licence text
is not reported again by the rules for its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words (or their beginnings) of which every known sentence has one.
TRIGGERS = ("licen", "redistribut", "permission", "warrant", "copyright", "liable", "unencumbered", "endorse",
            "applicable", "attribution", "reserved", "cc0", "spdx", "later version")

# Identifier and pattern of known sentences, on normalised text
# (lower case, everything but letters, digits, dots and plus signs one space).
# A sentence has all identifiers that are found in it, in this order.
SENTENCES = (
    ("spdx-mit", r"spdx license identifier mit\b"),
    ("spdx-apache-2.0", r"spdx license identifier apache 2\.0"),
    ("spdx-bsd-3", r"spdx license identifier bsd 3 clause"),
    ("spdx-bsd-2", r"spdx license identifier bsd 2 clause"),
    ("spdx-gpl-3.0", r"spdx license identifier gpl 3\.0"),
    ("spdx-gpl-2.0", r"spdx license identifier gpl 2\.0"),
    ("spdx-mpl-2.0", r"spdx license identifier mpl 2\.0"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit-notice", r"above copyright notice and this permission notice shall be included"),
    ("as-is", r"the software is provided as is without warranty of any kind"),
    ("no-liability", r"in no event shall the authors or copyright holders be liable"),
    ("isc-grant", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-endorse", r"neither the name of .* may be used to endorse or promote products"),
    ("bsd-as-is", r"this software is provided by .* as is and any express or implied warranties"),
    ("apache-2.0-ref", r"licensed under the apache license version 2\b"),
    ("apache-terms", r"you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at"),
    ("apache-as-is", r"unless required by applicable law or agreed to in writing software"),
    ("lgpl-grant", r"redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl-grant", r"redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl-2.0-grant", r"redistribute it and or modify it under the terms of the gnu general public license .*version 2\b"),
    ("gpl-3.0-grant", r"redistribute it and or modify it under the terms of the gnu general public license .*version 3\b"),
    ("gpl-grant", r"redistribute it and or modify it under the terms of the gnu general public license[^0-9]*$"),
    ("gpl-version-2", r"^ ?(?:either )?version 2 (?:of the license|or at your option|or any later version)"),
    ("gpl-version-2.1", r"^ ?(?:either )?version 2\.1 (?:of the license|or at your option|or any later version)"),
    ("gpl-version-3", r"^ ?(?:either )?version 3 (?:of the license|or at your option|or any later version)"),
    ("gpl-warranty", r"distributed in the hope that it will be useful but without any warranty"),
    ("gpl-copy", r"you should have received a copy of the gnu (?:lesser |affero )?general public license"),
    ("gpl-3.0-ref", r"licensed under the gnu general public license version 3\b"),
    ("gpl-2.0-ref", r"licensed under the gnu general public license version 2\b"),
    ("mpl-2.0-ref", r"subject to the terms of the mozilla public license v\.? ?2\.0"),
    ("mit-ref", r"(?:released|licensed|distributed) under the (?:terms of the )?mit license"),
    ("bsd-ref", r"(?:released|licensed|distributed) under the (?:terms of the )?bsd license"),
    ("cc-by-nc-sa-4.0-ref", r"licensed under cc by nc sa 4\.0|attribution noncommercial sharealike 4\.0"),
    ("cc-by-nc-4.0-ref", r"licensed under cc by nc 4\.0|attribution noncommercial 4\.0"),
    ("cc-by-sa-4.0-ref", r"licensed under cc by sa 4\.0|attribution sharealike 4\.0"),
    ("cc-by-4.0-ref", r"licensed under cc by 4\.0|creative commons attribution 4\.0"),
    ("cc0-ref", r"cc0 1\.0 universal|dedicated to the public domain under cc0|associated cc0 with"),
    ("unlicense", r"free and unencumbered software released into the public domain"),
    ("copyright", r"copyright (?:c )?[0-9][0-9][0-9][0-9]\b"),
    ("all-rights", r"all rights reserved"),
)

# Licence and the sequence of sentences that states it, in the
# order in which they are tried.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-2.0-ref", "apache-terms", "apache-copy", "apache-as-is")),
    ("Apache-2.0", ("apache-2.0-ref", "apache-copy", "apache-as-is")),
    ("LGPL", ("lgpl-grant", "gpl-version-2", "gpl-warranty", "gpl-copy")),
    ("LGPL", ("lgpl-grant", "gpl-version-2.1", "gpl-warranty", "gpl-copy")),
    ("LGPL", ("lgpl-grant", "gpl-version-3", "gpl-warranty", "gpl-copy")),
    ("AGPL-3.0", ("agpl-grant", "gpl-version-3", "gpl-warranty", "gpl-copy")),
    ("GPL-2.0", ("gpl-grant", "gpl-version-2", "gpl-warranty", "gpl-copy")),
    ("GPL-3.0", ("gpl-grant", "gpl-version-3", "gpl-warranty", "gpl-copy")),
    ("LGPL", ("lgpl-grant", "gpl-warranty", "gpl-copy")),
    ("AGPL-3.0", ("agpl-grant", "gpl-warranty", "gpl-copy")),
    ("GPL-2.0", ("gpl-2.0-grant", "gpl-warranty", "gpl-copy")),
    ("GPL-3.0", ("gpl-3.0-grant", "gpl-warranty", "gpl-copy")),
    ("LGPL", ("lgpl-grant", "gpl-version-2")),
    ("LGPL", ("lgpl-grant", "gpl-version-2.1")),
    ("LGPL", ("lgpl-grant", "gpl-version-3")),
    ("AGPL-3.0", ("agpl-grant", "gpl-version-3")),
    ("GPL-2.0", ("gpl-grant", "gpl-version-2")),
    ("GPL-3.0", ("gpl-grant", "gpl-version-3")),
    ("LGPL", ("lgpl-grant",)),
    ("AGPL-3.0", ("agpl-grant",)),
    ("GPL-2.0", ("gpl-2.0-grant",)),
    ("GPL-3.0", ("gpl-3.0-grant",)),
    ("Apache-2.0", ("apache-2.0-ref",)),
    ("GPL-3.0", ("gpl-3.0-ref",)),
    ("GPL-2.0", ("gpl-2.0-ref",)),
    ("MPL-2.0", ("mpl-2.0-ref",)),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-grant",)),
    ("BSD", ("bsd-ref",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4.0-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0-ref",)),
    ("CC-BY-4.0", ("cc-by-4.0-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("Unlicense", ("unlicense",)),
    ("MIT", ("spdx-mit",)),
    ("Apache-2.0", ("spdx-apache-2.0",)),
    ("BSD-3-Clause", ("spdx-bsd-3",)),
    ("BSD-2-Clause", ("spdx-bsd-2",)),
    ("GPL-3.0", ("spdx-gpl-3.0",)),
    ("GPL-2.0", ("spdx-gpl-2.0",)),
    ("MPL-2.0", ("spdx-mpl-2.0",)),
    ("Copyrighted", ("copyright", "all-rights")),
    ("Copyrighted", ("all-rights",)),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Where a sentence ends: the mark is kept, the white space becomes a separator.
#: The stop of ``v. 2.0`` ends none.
SENTENCE_END = "([!?;]|(?<!\\bv)\\.|\\.(?![ \t\r\n]+[0-9]))[ \t\r\n]+|\r?\n[ \t]*\r?\n"
SEPARATOR = "\x01"


def sentence_ids(low: Column) -> Column:
    """Identifiers of the known sentences of a lower-cased text, in order."""
    parts = F.split(F.regexp_replace(F.translate(low, SEPARATOR, " "), SENTENCE_END, f"$1{SEPARATOR}"), SEPARATOR)
    known = F.filter(parts, lambda s: _has_trigger(s))

    plain = F.transform(known, lambda s: F.regexp_replace(s, "[^a-z0-9.+]+", " "))
    names = F.flatten(F.transform(plain, lambda p: F.array(
        *[F.when(p.rlike(pattern), F.lit(ident)) for ident, pattern in SENTENCES])))
    return F.filter(names, lambda x: x.isNotNull())


def _has_trigger(s: Column) -> Column:
    found = F.lit(False)
    for t in TRIGGERS:
        found = found | s.contains(t)
    return found


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences stated in every whole text.

    Columns: doc_id, licenses (names in the order of the rules, each once, joined
    by commas; empty if none), n_sentences (identifiers of known sentences),
    sentences (these identifiers, joined by blanks), unmatched (identifiers that no rule took).
    A null or empty text has none.  Each row gives a row; no shuffle.  The long
    expressions are evaluated only for texts that hold a trigger word.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    low = F.translate(text, UPPER, LOWER)
    none = F.array().cast("array<string>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), low.alias("low"))
    rows = rows.select("doc_id", F.when(_has_trigger(F.col("low")), sentence_ids(F.col("low")))
                       .otherwise(none).alias("ids"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{s}>" for s in seq)).alias("seq"))
                      for name, seq in RULES])
    start = F.struct(F.array_join(F.transform("ids", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "").alias("rest"),
                     none.alias("names"))
    # a matched sequence leaves a bar, so what stood around it does not become adjacent
    step = lambda acc, r: F.when(
        F.contains(acc["rest"], r["seq"]),
        F.struct(F.replace(acc["rest"], r["seq"], F.lit("|")).alias("rest"),
                 F.array_union(acc["names"], F.array(r["name"])).alias("names"))).otherwise(acc)
    rows = rows.withColumn("found", F.when(F.size("ids") > 0, F.aggregate(rules, start, step)))
    rest = F.trim(F.regexp_replace(F.coalesce(F.col("found.rest"), F.lit("")), "[<>|]+", " "))
    return rows.select("doc_id", F.array_join(F.coalesce(F.col("found.names"), none), ",").alias("licenses"),
                       F.size("ids").cast("long").alias("n_sentences"),
                       F.array_join("ids", " ").alias("sentences"), rest.alias("unmatched"))


def oracle_sql(table: str = "documents") -> str:
    """The same scan as DuckDB SQL, built from the same fixed values."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    triggers = lambda c: "(" + " OR ".join(f"contains({c}, {quote(t)})" for t in TRIGGERS) + ")"
    cases = ", ".join(f"CASE WHEN regexp_matches(p, {quote(p)}) THEN {quote(i)} END" for i, p in SENTENCES)
    end = "([.!?;])[ \\t\\r\\n]+|\\r?\\n[ \\t]*\\r?\\n"
    # no look-behind there: the stop of "v. 2.0" is put away while sentences are cut
    low = f"regexp_replace(replace(replace(low, chr(1), ' '), chr(2), ' '), '\\bv\\.([ \\t\\r\\n]+[0-9])', 'v' || chr(2) || '\\1', 'g')"
    steps, last = [], "r0"
    for k, (name, seq) in enumerate(RULES):
        text = quote("".join(f"<{s}>" for s in seq))
        steps.append(
            f"r{k + 1} AS (SELECT doc_id, ids, CASE WHEN contains(rest, {text}) THEN replace(rest, {text}, '|') "
            f"ELSE rest END AS rest, CASE WHEN contains(rest, {text}) AND NOT list_contains(names, {quote(name)}) "
            f"THEN list_append(names, {quote(name)}) ELSE names END AS names FROM {last})")
        last = f"r{k + 1}"
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM {table}),
s AS (SELECT doc_id, CASE WHEN {triggers('low')} THEN [s for s in
    [replace(x, chr(2), '.') for x in string_split(regexp_replace({low}, '{end}', '\\1' || chr(1), 'g'), chr(1))]
    if {triggers('s')}]
    ELSE []::VARCHAR[] END AS known FROM d),
t AS (SELECT doc_id, [regexp_replace(s, '[^a-z0-9.+]+', ' ', 'g') for s in known] AS plain FROM s),
n AS (SELECT doc_id, flatten([[{cases}] for p in plain]) AS names FROM t),
i AS (SELECT doc_id, [x for x in names if x IS NOT NULL] AS ids FROM n),
r0 AS (SELECT doc_id, ids, array_to_string(['<' || x || '>' for x in ids], '') AS rest,
    []::VARCHAR[] AS names FROM i),
{", ".join(steps)}
SELECT doc_id, coalesce(array_to_string(names, ','), '') AS licenses, len(ids)::BIGINT AS n_sentences,
    coalesce(array_to_string(ids, ' '), '') AS sentences,
    trim(regexp_replace(coalesce(rest, ''), '[<>|]+', ' ', 'g')) AS unmatched
FROM {last}"""
