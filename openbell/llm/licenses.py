"""License recognition by sentences and ordered sentence rules.

Every sentence of a text is normalised (A-Z lower-cased, runs of other characters than a-z and 0-9 become one
space) and looked up among the known licence sentences; the identifiers found, in text order, form the document's
sequence. Single lines are looked up, and also every run of lines of a paragraph, as texts are often wrapped: a line
break inside it is a space, sentence punctuation and lines without letters and digits are breaks. Runs come in the
order of their first and then of their last line. A rule is an ordered list of identifiers and matches where it stands as a contiguous run of that
sequence. The whole lookup is one map expression per row: no shuffle, no Python.

Defined cases: a null or empty text has no sentences and no licence; unknown sentences between known ones do not
break a run; repeated rows are judged one by one; very long texts are read whole, as one row; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.llm.common import UPPER, ascii_lower, table

# Normalised licence sentences (public licence texts) and their identifiers
SENTENCES = {
    "all rights reserved": "reserved",
    "licensed under cc by 4 0": "cc-by-notice",
    "licensed under cc by sa 4 0": "cc-by-sa-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-notice",
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "licensed under the apache license version 2 0": "apache-notice",
    "licensed under the apache license version 2 0 the license": "apache-head",
    "you may not use this file except in compliance with the license": "apache-condition",
    "you may obtain a copy of the license at": "apache-copy",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
    "free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd-endorse",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
    "free software foundation": "gpl-terms",
    "either version 2 of the license or at your option any later version": "version2-later",
    "this library is free software": "lgpl-free",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
    "the free software foundation": "lgpl-terms",
    "either version 2 1 of the license or at your option any later version": "version2.1-later",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
    "the free software foundation either version 3 of the license or at your option any later version": "lgpl3-later",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
    "the free software foundation either version 3 of the license or at your option any later version": "agpl3-later",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-head",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl-copy",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all "
    "implied warranties of merchantability and fitness": "isc-warranty",
    "this is free and unencumbered software released into the public domain": "unlicense-head",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as "
    "a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-grant",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to "
    "this software to the public domain worldwide": "cc0-notice",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter "
    "it and redistribute it freely subject to the following restrictions": "zlib-grant",
}

# Licence, ordered sentence identifiers
RULES = [
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-head", "apache-condition", "apache-copy"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-grant", "mit-condition", "mit-warranty"]),
    ("proprietary", ["reserved"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl3-later"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-terms", "version2-later"]),
    ("ISC", ["isc-grant", "isc-warranty"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl-terms", "version2.1-later"]),
    ("LGPL-3.0-or-later", ["lgpl-free", "lgpl3-later"]),
    ("MPL-2.0", ["mpl-head", "mpl-copy"]),
    ("Unlicense", ["unlicense-head", "unlicense-grant"]),
    ("Zlib", ["zlib-warranty", "zlib-grant"]),
]

#: Sentence punctuation before white space or the end of a line, or lines without letters and digits.
PARAGRAPH = r"[.!?;:](?:[ \t\r]|(?=\n))|\n(?:[^A-Za-z0-9\n]*\n)+"


def normalise(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(sentence), "[^a-z0-9]+", " "))


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """One row per document: (doc_id, n_known, sentence_ids, licenses, license).

    ``sentence_ids`` joins the known identifiers in text order with commas, ``licenses`` the matched licences in
    name order; ``license`` is that of the longest matching rule (ties: the first name), null without a match.
    """
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    most = max(len(s.split()) for s in sentences)  # a run has a word of each line
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def runs(paragraph: Column) -> Column:
        lines = F.filter(F.transform(F.split(paragraph, "\n"), normalise), lambda x: x != "")

        def from_line(pieces: Column, i: Column) -> Column:
            ends = F.sequence(F.lit(1), F.least(F.size(pieces) - i, F.lit(most)))
            ids = F.transform(ends, lambda n: F.element_at(known, F.array_join(F.slice(pieces, i + 1, n), " ")))
            starts = F.array_contains(F.transform(F.map_keys(known), lambda s: s.startswith(F.get(pieces, i))), True)
            return F.when(starts, F.filter(ids, lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))

        # one element in an array binds the lines, so that they are made once
        bound = F.transform(F.array(lines), lambda x: F.flatten(F.transform(x, lambda _, i: from_line(x, i))))
        return F.element_at(bound, 1)

    # a text that holds no known sentence anywhere has none as a run
    whole = normalise(text)
    some = F.lit(False)
    for sentence in sentences:
        some = some | F.col("_whole").contains(sentence)
    found = F.when(F.col("_some"), F.flatten(F.transform(F.split(F.col("_text"), PARAGRAPH), runs))).otherwise(F.array().cast("array<string>"))
    run = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(","))
    hits = [(len(ids), name, run.contains("," + ",".join(ids) + ",")) for name, ids in rules]
    ranked = sorted(hits, key=lambda x: (-x[0], x[1]))
    names = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(hit, F.lit(name)) for _, name, hit in hits]))))
    return (
        docs.select("doc_id", text.alias("_text"), whole.alias("_whole"))
        .select("doc_id", "_text", some.alias("_some"))
        .select("doc_id", found.alias("ids"))
        .select("doc_id", F.size("ids").cast("long").alias("n_known"), F.array_join("ids", ",").alias("sentence_ids"))
        .withColumn("licenses", F.array_join(names, ","))
        .withColumn("license", F.coalesce(*[F.when(hit, F.lit(name)) for _, name, hit in ranked]))
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in SENTENCES.items())
    hit = lambda ids: f"contains(',' || sentence_ids || ',', {quote(',' + ','.join(ids) + ',')})"
    listed = ", ".join(f"CASE WHEN {hit(ids)} THEN {quote(name)} END" for name, ids in RULES)
    ranked = sorted(RULES, key=lambda r: (-len(r[1]), r[0]))
    first = " ".join(f"WHEN {hit(ids)} THEN {quote(name)}" for name, ids in ranked)
    norm = lambda x: f"trim(regexp_replace(translate({x}, '{UPPER}', '{UPPER.lower()}'), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH known(sentence, id) AS (VALUES {values}),
some_known AS (
  SELECT DISTINCT doc_id, text FROM (SELECT doc_id, text, {norm('text')} AS whole FROM documents) JOIN known ON contains(whole, sentence)
), parts AS (  -- a space for the line break that may follow a sentence's end
  SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?;:])\\n', '\\1 ' || chr(10), 'g'),
         '[.!?;:][ \\t\\r]|\\n(?:[^A-Za-z0-9\\n]*\\n)+') AS p FROM some_known
), paragraphs AS (
  SELECT doc_id, generate_subscripts(p, 1) AS k, unnest(p) AS p FROM parts
), pieces AS (
  SELECT doc_id, k, list_filter(list_transform(string_split(p, chr(10)), lambda x: {norm('x')}), lambda x: x <> '') AS l FROM paragraphs
), lines AS (
  SELECT doc_id, k, l, generate_subscripts(l, 1) AS i, unnest(l) AS s FROM pieces
), runs AS (
  SELECT doc_id, k, l, i, id, sentence, unnest(range(i, len(l) + 1)) AS j FROM lines JOIN known ON starts_with(sentence, s)
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY k, i, j) AS ids FROM runs
  WHERE array_to_string(l[i:j], ' ') = sentence GROUP BY doc_id
), all_docs AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_known, coalesce(ids, '') AS sentence_ids
  FROM documents d LEFT JOIN found USING (doc_id)
)
SELECT doc_id, n_known::BIGINT AS n_known, sentence_ids,
       array_to_string(list_sort(list_distinct(list_filter([{listed}], lambda x: x IS NOT NULL))), ',') AS licenses,
       CASE {first} END AS license
FROM all_docs
"""


ORACLE_SQL = _sql()
