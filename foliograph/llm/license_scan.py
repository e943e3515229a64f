"""Licence recognition by known sentences and ordered rules.

Texts are cut into sentences, normalised (lower case, anything but letters and
digits becomes one space) and compared with a table of known sentences; what
is known becomes a sequence of identifiers.  Each line is a sentence, and so are
lines that follow one another without a sentence mark or an empty line (or one
of comment marks only) between them: of overlapping ones the leftmost is known,
and of these the longest.  Rules are sequences of
identifiers in an order of precedence; a rule matches where its identifiers
come in this order, with others between them.  Only recognised sentences leave the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Identifier -> normalised names of a licence, as they follow an opening.
NAMES = {
    "apache-header": (
        "apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache 2 0 license", "apache 2 0",
        "apache version 2 0 license", "apache software license version 2 0", "apache license version 2 0 the license",
    ),
    "mit-header": ("mit license", "mit", "mit licence", "mit expat license", "expat license", "mit open source license"),
    "gpl2-header": (
        "gnu general public license version 2", "gnu general public license v2 0", "gnu gpl version 2", "gnu gpl v2",
        "gplv2", "gpl v2", "gpl 2 0", "gplv2 license", "gnu general public license version 2 or later",
    ),
    "gpl3-header": (
        "gnu general public license version 3", "gnu general public license v3 0", "gnu gpl version 3", "gnu gpl v3",
        "gplv3", "gpl v3", "gpl 3 0", "gplv3 license", "gnu general public license version 3 or later",
    ),
    "gpl-header": ("gnu general public license", "gnu gpl", "gpl", "gpl license"),
    "lgpl21-header": ("gnu lesser general public license version 2 1", "gnu lgpl version 2 1", "lgpl v2 1", "lgpl 2 1"),
    "lgpl3-header": ("gnu lesser general public license version 3", "gnu lgpl version 3", "lgplv3", "lgpl v3", "lgpl 3 0"),
    "lgpl-header": ("gnu lesser general public license", "gnu lgpl", "lgpl"),
    "agpl3-header": (
        "gnu affero general public license version 3", "gnu affero general public license v3 0", "gnu agpl version 3",
        "agplv3", "agpl v3", "agpl 3 0",
    ),
    "agpl-header": ("gnu affero general public license", "gnu agpl", "agpl"),
    "mpl2-header": ("mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v2 0", "mpl 2 0"),
    "bsd-header": ("bsd 3 clause license", "3 clause bsd license", "bsd 3 clause", "new bsd license", "modified bsd license"),
    "bsd2-header": ("bsd 2 clause license", "2 clause bsd license", "bsd 2 clause", "simplified bsd license"),
    "bsd-any-header": ("bsd license", "bsd"),
    "isc-header": ("isc license", "isc"),
    "zlib-header": ("zlib license", "zlib libpng license"),
    "boost-header": ("boost software license version 1 0", "boost software license"),
    "epl2-header": ("eclipse public license version 2 0", "eclipse public license 2 0", "eclipse public license v2 0"),
    "unlicense-header": ("unlicense",),
    "cc-by": ("cc by 4 0", "cc by 4 0 license", "creative commons attribution 4 0 international license", "creative commons attribution 4 0 license"),
    "cc-by-sa": (
        "cc by sa 4 0", "cc by sa 4 0 license", "creative commons attribution sharealike 4 0 international license",
        "creative commons attribution sharealike 4 0 license",
    ),
    "cc-by-nc": (
        "cc by nc 4 0", "cc by nc 4 0 license", "creative commons attribution noncommercial 4 0 international license",
        "creative commons attribution noncommercial 4 0 license",
    ),
    "cc-zero": ("cc0 1 0", "cc0", "cc0 license", "cc0 1 0 universal", "creative commons zero v1 0 universal", "creative commons cc0 license"),
}
SUBJECTS = ("", "this work is ", "this software is ", "this project is ", "this program is ", "this file is ", "this library is ", "this code is ")
VERBS = ("licensed", "released", "distributed", "published", "available", "made available")
LINKS = ("under", "under the", "under a", "under the terms of the")

# Identifier -> normalised sentences of well-known licence texts that have no such opening.
TEXTS = {
    "apache-title": ("apache license version 2 0", "apache license version 2 0 january 2004"),
    "apache-limit": ("you may not use this file except in compliance with the license",),
    "apache-copy": ("you may obtain a copy of the license at",),
    "mit-title": ("the mit license mit", "the mit license", "mit license"),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    # Heads of the licence files.
    "gpl2-title": ("gnu general public license version 2 june 1991",),
    "gpl3-title": ("gnu general public license version 3 29 june 2007",),
    "lgpl21-title": ("gnu lesser general public license version 2 1 february 1999",),
    "lgpl3-title": ("gnu lesser general public license version 3 29 june 2007",),
    "agpl3-title": ("gnu affero general public license version 3 19 november 2007",),
    "mpl2-title": ("mozilla public license version 2 0",),
    "bsd-title": ("bsd 3 clause license", "the 3 clause bsd license"),
    "bsd2-title": ("bsd 2 clause license", "the 2 clause bsd license"),
    "isc-title": ("isc license", "the isc license"),
    # A GNU notice breaks behind "free software".
    **{
        f"{name}-notice": tuple(
            f"you can redistribute it and or modify it under the terms of the gnu {kind}general public license as published by "
            f"the free software foundation {version}"
            for version in (f"either version {n} of the license or at your option any later version", f"version {n} of the license", f"version {n}")
        )
        for name, kind, n in (
            ("gpl2", "", "2"), ("gpl3", "", "3"), ("lgpl21", "lesser ", "2 1"), ("lgpl3", "lesser ", "3"), ("agpl3", "affero ", "3"),
        )
    },
    # Older notices have a semicolon there, which ends a sentence.
    **{
        f"gnu{name}-grant": (
            f"you can redistribute it and or modify it under the terms of the gnu {kind}general public license as published by "
            "the free software foundation",
        )
        for name, kind in (("", ""), ("-lesser", "lesser "), ("-affero", "affero "))
    },
    **{
        f"version-{n.replace(' ', '.')}": (
            f"either version {n} of the license or at your option any later version", f"version {n} of the license",
        )
        for n in ("2", "2 1", "3")
    },
    # The sentence mark of "v. 2.0" ends it.
    "mpl2-notice": ("this source code form is subject to the terms of the mozilla public license v",),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "bsd-endorse": tuple(
        f"neither the name of {owner} nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission"
        for owner in (
            "the copyright holder", "the copyright owner", "the university", "the organization", "the organization s",
            "the author", "the company", "the project",
        )
    ),
    "isc-grant": tuple(
        f"permission to use copy modify and {either}distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies"
        for either in ("", "or ")
    ),
    "unlicense-text": ("this is free and unencumbered software released into the public domain",),
    "reserved": ("all rights reserved",),
}


# Identifier of a licence in "SPDX-License-Identifier" lines -> its rule.
SPDX = {
    "Apache-2.0": "apache-2.0", "MIT": "mit", "AGPL-3.0": "agpl-3.0", "GPL-3.0": "gpl-3.0", "GPL-2.0": "gpl-2.0",
    "LGPL-3.0": "lgpl-3.0", "LGPL-2.1": "lgpl-2.1", "MPL-2.0": "mpl-2.0", "EPL-2.0": "epl-2.0",
    "BSD-3-Clause": "bsd-3-clause", "BSD-2-Clause": "bsd-2-clause", "ISC": "isc", "Zlib": "zlib", "BSL-1.0": "bsl-1.0",
    "Unlicense": "unlicense", "CC-BY-4.0": "cc-by-4.0", "CC-BY-SA-4.0": "cc-by-sa-4.0", "CC-BY-NC-4.0": "cc-by-nc-4.0",
    "CC0-1.0": "cc0-1.0",
}


class Wordings(tuple):
    """Pairs of identifier and sentence: an identifier has many sentences, a sentence one identifier."""

    def items(self) -> Wordings:
        return self


def _wordings() -> Wordings:
    own: dict[str, str] = {}
    for known, names in NAMES.items():
        for name in names:
            for subject in SUBJECTS:
                for verb in VERBS:
                    for link in LINKS:
                        own.setdefault(f"{subject}{verb} {link} {name}", known)
    for known, texts in TEXTS.items():
        for text in texts:
            own.setdefault(text, known)
    for spdx, name in SPDX.items():
        for suffix in ("", " only", " or later"):
            own.setdefault("spdx license identifier " + re.sub(r"[^a-z0-9]+", " ", spdx.lower()) + suffix, f"{name}-spdx")
    return Wordings((known, sentence) for sentence, known in own.items())


SENTENCES = _wordings()

# Rule -> identifiers in this order, others between them allowed, none
# of those with a minus; strongest rule first.  A rule's licence is its name up to "/".
RULES = {
    "apache-2.0/notice": ("apache-header", "apache-limit"),
    "apache-2.0": ("apache-header",),
    "apache-2.0/title": ("apache-title",),
    "mit": ("mit-header",),
    "mit/title": ("mit-title",),
    "mit/grant": ("mit-grant",),
    "agpl-3.0": ("agpl3-header",),
    "agpl-3.0/notice": ("agpl3-notice",),
    "agpl-3.0/terms": ("gnu-affero-grant", "version-3"),
    "agpl-3.0/title": ("agpl3-title",),
    "agpl": ("agpl-header",),
    "gpl-3.0": ("gpl3-header",),
    "gpl-3.0/notice": ("gpl3-notice",),
    "gpl-3.0/terms": ("gnu-grant", "version-3"),
    "gpl-3.0/title": ("gpl3-title",),
    "gpl-2.0": ("gpl2-header",),
    "gpl-2.0/notice": ("gpl2-notice",),
    "gpl-2.0/terms": ("gnu-grant", "version-2"),
    "gpl-2.0/title": ("gpl2-title",),
    "gpl": ("gpl-header",),
    "lgpl-3.0": ("lgpl3-header",),
    "lgpl-3.0/notice": ("lgpl3-notice",),
    "lgpl-3.0/terms": ("gnu-lesser-grant", "version-3"),
    "lgpl-3.0/title": ("lgpl3-title",),
    "lgpl-2.1": ("lgpl21-header",),
    "lgpl-2.1/notice": ("lgpl21-notice",),
    "lgpl-2.1/terms": ("gnu-lesser-grant", "version-2.1"),
    "lgpl-2.1/title": ("lgpl21-title",),
    "lgpl": ("lgpl-header",),
    "mpl-2.0": ("mpl2-header",),
    "mpl-2.0/notice": ("mpl2-notice",),
    "mpl-2.0/title": ("mpl2-title",),
    "epl-2.0": ("epl2-header",),
    "bsd-3-clause/text": ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"),
    "bsd-3-clause": ("bsd-header",),
    "bsd-3-clause/title": ("bsd-title",),
    "bsd-2-clause/text": ("bsd-grant", "bsd-source", "bsd-binary", "-bsd-endorse"),
    "bsd-2-clause": ("bsd2-header",),
    "bsd-2-clause/title": ("bsd2-title",),
    "bsd": ("bsd-any-header",),
    "bsd/grant": ("bsd-grant", "-bsd-binary"),
    "isc": ("isc-header",),
    "isc/title": ("isc-title",),
    "isc/grant": ("isc-grant",),
    "zlib": ("zlib-header",),
    "bsl-1.0": ("boost-header",),
    "unlicense": ("unlicense-header",),
    "unlicense/text": ("unlicense-text",),
    "cc-by-nc-4.0": ("cc-by-nc",),
    "cc-by-sa-4.0": ("cc-by-sa",),
    "cc-by-4.0": ("cc-by",),
    "cc0-1.0": ("cc-zero",),
    **{f"{name}/spdx": (f"{name}-spdx",) for name in SPDX.values()},
    "all-rights-reserved": ("reserved",),
}


def licence(rule: str) -> str:
    return rule.split("/")[0]


def pattern(sequence: tuple[str, ...]) -> str:
    """A regular expression of the identifiers between commas, with gaps."""
    return "," + ",(?:.*,)?".join(known for known in sequence if known[0] != "-") + ","


def absent(sequence: tuple[str, ...]) -> list[str]:
    return [known[1:] for known in sequence if known[0] == "-"]


# A colon ends a sentence, but not behind the words "SPDX-License-Identifier";
# licences joined by OR or AND, up to three, are as many lines.
SPDX_WORDS = (r"(?i)spdx-license-identifier:[ \t]*", "spdx license identifier ")
SPDX_PAIR = (
    r"(spdx license identifier )\(?([A-Za-z0-9.+-]+)\)?[ \t]+(?:OR|AND)[ \t]+\(?([A-Za-z0-9.+-]+)",
    "$1$2\n\n$1$3",
)
MARKS = r"[.!?;:]+(?=[ \t\r\n]|$)"
MAX_SENTENCES = 20_000


def normalised(text: Column) -> Column:
    """Normalised lines, an empty line behind each sentence mark."""
    spdx = F.regexp_replace(F.coalesce(text, F.lit("")), *SPDX_WORDS)
    for _ in range(2):
        spdx = F.regexp_replace(spdx, *SPDX_PAIR)
    marked = F.regexp_replace(spdx, MARKS, "\n\n")
    return F.regexp_replace(F.regexp_replace(F.lower(marked), r"[^a-z0-9\n]+", " "), " ?\n ?", "\n")


def _runs(lines: Column, heads: set[str], longest: int) -> Column:
    """``at, last, sentence`` of all runs of lines that begin like a known sentence and are not longer than one."""

    def joined(i: Column, n: Column) -> Column:
        return F.array_join(F.slice(lines, i + 1, n), " ")

    def at(line: Column, i: Column) -> Column:
        # A line has a word at least, so more lines than words cannot match.
        most = F.least(F.size(lines) - i, F.lit(longest))
        runs = F.transform(
            F.sequence(F.lit(1), most), lambda n: F.struct(i.alias("at"), (i + n - 1).alias("last"), joined(i, n).alias("sentence"))
        )
        return F.when(F.substring_index(line, " ", 2).isin(heads), runs)

    return F.flatten(F.array_compact(F.transform(lines, at)))


def _leftmost_longest(found: Column) -> Column:
    """Identifiers of the runs that do not overlap; ``found`` has ``paragraph, at, back, known`` in order."""
    start = F.struct(
        F.lit(-1).alias("paragraph"), F.lit(-1).alias("last"), F.array().cast("array<string>").alias("ids")
    )
    return F.aggregate(
        found,
        start,
        lambda done, x: F.when((x["paragraph"] == done["paragraph"]) & (x["at"] <= done["last"]), done).otherwise(
            F.struct(
                x["paragraph"].alias("paragraph"),
                (-x["back"]).alias("last"),
                F.concat(done["ids"], F.array(x["known"])).alias("ids"),
            )
        ),
        lambda done: done["ids"],
    )


def scan(
    docs: DataFrame,
    sentences: Wordings | dict[str, str] = SENTENCES,
    rules: dict[str, tuple[str, ...]] = RULES,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, ``n_sentences``, ``sentence_ids``, ``licenses`` and ``license``.

    ``n_sentences`` counts pieces between sentence marks and line ends.
    ``sentence_ids`` joins the recognised identifiers in text order by commas,
    ``licenses`` the licences of the matching rules in rule order; ``license``
    is the first of these or null.  A null text has no sentence; repeated rows give repeated
    results; an empty table gives none; other columns are not looked at.
    """
    if len(sentences) > MAX_SENTENCES:
        raise ValueError(f"at most {MAX_SENTENCES} known sentences")
    spark = docs.sparkSession
    known = F.broadcast(spark.createDataFrame([(s, i) for i, s in sentences.items()], "sentence string, known string"))
    split = [s.split(" ") for _, s in sentences.items()]
    heads = {w[0] for w in split} | {" ".join(w[:2]) for w in split}
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).select(
        "id", F.xxhash64("text").alias("content"), F.trim(normalised(F.col("text"))).alias("text")
    )
    runs = (
        rows.select("id", "content", F.posexplode(F.split("text", "\n\n+")).alias("paragraph", "text"))
        .withColumn("lines", F.array_remove(F.split("text", "\n"), ""))
        .select("id", "content", "paragraph", F.explode(_runs(F.col("lines"), heads, max(map(len, split)))).alias("run"))
    )
    found = (
        runs.select("id", "content", "paragraph", "run.*")
        .join(known, "sentence")
        .groupBy(F.xxhash64("id").alias("row"), "content")
        # Copies of a row have the same runs.
        .agg(F.sort_array(F.collect_set(F.struct("paragraph", "at", (-F.col("last")).alias("back"), "known"))).alias("found"))
        .select("row", "content", _leftmost_longest(F.col("found")).alias("found"))
    )
    joined = rows.select("id", "content", F.regexp_count("text", F.lit(r"[^\n]+")).cast("bigint").alias("n_sentences")).withColumn(
        "row", F.xxhash64("id")
    ).join(found, ["row", "content"], "left")
    ids = F.coalesce(F.array_join("found", ","), F.lit(""))
    inside = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(","))
    named = []
    for rule, sequence in rules.items():
        matches = F.rlike(inside, F.lit(pattern(sequence)))
        for known_ in absent(sequence):
            matches = matches & ~F.contains(inside, F.lit(f",{known_},"))
        named.append(F.when(matches, F.lit(licence(rule))))
    matching = F.when(F.col("sentence_ids") != "", F.array_distinct(F.array_compact(F.array(*named)))).otherwise(
        F.array().cast("array<string>")
    )
    return (
        joined.select("id", "n_sentences", ids.alias("sentence_ids"))
        .withColumn("matching", matching)
        .select(
            F.col("id").alias(id_col), "n_sentences", "sentence_ids",
            F.array_join("matching", ",").alias("licenses"), F.get("matching", F.lit(0)).alias("license"),
        )
    )
