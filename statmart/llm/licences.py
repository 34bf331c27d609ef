"""Licence scans by sentence rules.

A text is cut into sentences, each normalised to lower-case words. Known licence sentences have
identifiers; a text's identifiers, in the order they stand, are matched against an ordered list
of licence rules, each a sequence of identifiers. An earlier rule takes its sentences away from
the later ones, so a full notice is not reported again as its parts. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentence ends: a mark followed by white space, or a line's end.
SENTENCE_END = r"[.!?:;]+[ \t\r]+|[ \t\r]*\n+"
#: What separates words once a sentence is in lower case.
BETWEEN_WORDS = "[^a-z0-9]+"

#: Sentences of public licence texts and notices, as normalised.
SENTENCES = {
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-licensed": "licensed under the apache license version 2 0",
    "apache-licensed-the": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl-redistribute-3": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-redistribute-2": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "mpl2-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc0": "cc0 1 0 universal",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
}

#: Licence and the sequence of sentences that stands for it; the first rules are the strongest.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("Apache-2.0", ["apache-licensed-the", "apache-comply", "apache-copy", "apache-as-is"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-redistribute-3"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-redistribute-2"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("Apache-2.0", ["apache-licensed-the"]),
    ("GPL-3.0", ["gpl3-work"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("All-rights-reserved", ["reserved"]),
]


def _known(text: Column, sentences: dict[str, str]) -> Column:
    """Identifiers of the known sentences of ``text``, in order."""
    table = F.create_map(*[F.lit(x) for i, s in sentences.items() for x in (s, i)])
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), SENTENCE_END)
    # Normalising never lengthens a sentence, so one that is shorter than all known ones matches none. A longer
    # one may: whatever stands between its words becomes single spaces.
    parts = F.filter(parts, lambda s: F.length(s) >= min(map(len, sentences.values())))
    ids = F.transform(parts, lambda s: F.try_element_at(table, F.trim(F.regexp_replace(s, BETWEEN_WORDS, " "))))
    return F.filter(ids, lambda i: i.isNotNull())


def _matched(ids: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """Licences whose rule matches a run of identifiers, strongest rule first."""
    rest, found = F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(",")), []
    table = F.array(
        *[F.struct(F.lit(n).alias("licence"), F.lit("," + ",,".join(s) + ",").alias("run")) for n, s in rules]
    )
    start = F.struct(rest.alias("rest"), F.array(*found).cast("array<string>").alias("found"))
    return F.aggregate(
        table,
        start,
        lambda a, r: F.when(
            F.contains(a["rest"], r["run"]),
            F.struct(
                # The space keeps what stood on both sides from becoming neighbours.
                F.replace(a["rest"], r["run"], F.lit(" ")).alias("rest"),
                F.array_union(a["found"], F.array(r["licence"])).alias("found"),
            ),
        ).otherwise(a),
        lambda a: a["found"],
    )


def scanned(
    df: DataFrame, text: str = "text", sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES
) -> DataFrame:
    """Add ``sentence_ids`` (known sentences, in order) and ``licences`` (distinct, strongest rule first).

    Whole texts are scanned. A null or empty text, or one without known sentences, gets empty
    arrays. Every row and column of ``df`` is kept; columns that bear an output's name are replaced.
    """
    ids = _known(F.col(text), sentences)
    return df.withColumn("sentence_ids", ids).withColumn(
        "licences",
        F.when(F.size("sentence_ids") > 0, _matched(F.col("sentence_ids"), rules)).otherwise(
            F.array().cast("array<string>")
        ),
    )


def oracle(sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> str:
    """The same scan of ``documents`` as SQL."""
    table = "MAP {" + ", ".join(f"'{s}': '{i}'" for i, s in sentences.items()) + "}"
    steps = ["SELECT doc_id, ids, CASE WHEN len(ids) > 0 THEN ',' || array_to_string(ids, ',,') || ',' ELSE '' END AS r0 FROM k"]
    for n, (_, run) in enumerate(rules):
        steps.append(f"SELECT *, replace(r{n}, ',{',,'.join(run)},', ' ') AS r{n + 1} FROM s{n}")
    ctes = ", ".join(f"s{n} AS ({q})" for n, q in enumerate(steps))
    hits = ", ".join(f"CASE WHEN r{n} <> r{n + 1} THEN '{name}' END" for n, (name, _) in enumerate(rules))
    return f"""WITH k AS (SELECT doc_id, list_filter(list_transform(
        string_split_regex(lower(coalesce(text, '')), '{SENTENCE_END}'),
        lambda s: {table}[trim(regexp_replace(s, '{BETWEEN_WORDS}', ' ', 'g'))]), lambda i: i IS NOT NULL) AS ids FROM documents), {ctes},
      f AS (SELECT doc_id, ids, list_filter([{hits}], lambda x: x IS NOT NULL) AS raw FROM s{len(rules)})
      SELECT doc_id, array_to_string(ids, ',') AS sentence_ids,
        array_to_string(list_filter(raw, lambda x, i: list_position(raw, x) = i), ',') AS licences,
        CAST(len(ids) AS BIGINT) AS n_sentences FROM f"""
