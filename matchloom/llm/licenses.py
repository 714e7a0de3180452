"""License scans by sentence rules.

Every sentence is normalised and looked up among known license sentences; the identifiers that a text's sentences
map to, in order, are matched against ordered rules. A rule names the identifiers of a license (or of its notice) in
order; unknown sentences may stand between two of them, known ones may not. A sentence is looked up twice: as it stands
on its line, and with single line breaks taken as wraps. One narrow plan: no shuffle, no Python; a text without any
word that all known sentences must hold one of is only counted.

Sentences and rules are tables in the plan: literals of a row per sentence (in buckets by hash, so a look-up reads a few)
and a row per rule. The plan's operations are the same for any number of them, and only texts that hold a known sentence meet
the rules.

Cases: null or empty text: no sentences, no license. Ties: a rule whose identifiers are part of a longer fitting rule
of the same text yields to that one; else every fitting rule is named, sorted. Repeated rows: each scanned. Very long
texts: arrays of one text's sentences, within one row. Other columns pass through; those named like the four results are replaced.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

#: Known sentences by identifier, as licenses print them.
SENTENCES = {
    "mit-ref": "Released under the MIT License.",
    "mit-ref-2": "Licensed under the MIT License.",
    "apache-ref": "Licensed under the Apache License, Version 2.0.",
    "apache-ref-2": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "gpl3-ref": "This work is licensed under the GNU General Public License, version 3.",
    "ccbync-ref": "Licensed under CC BY-NC 4.0.",
    "ccby-ref": "Licensed under CC BY 4.0.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "agpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mpl-ref": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-use": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-damages": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-ref": "Distributed under the Boost Software License, Version 1.0.",
}

#: (rule, license, identifiers in order)
RULES = [
    ("mit-reference", "MIT", ["mit-ref"]),
    ("mit-reference-2", "MIT", ["mit-ref-2"]),
    ("apache-reference", "Apache-2.0", ["apache-ref"]),
    ("gpl3-reference", "GPL-3.0-only", ["gpl3-ref"]),
    ("cc-by-nc-reference", "CC-BY-NC-4.0", ["ccbync-ref"]),
    ("cc-by-reference", "CC-BY-4.0", ["ccby-ref"]),
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("bsd-2-text", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("bsd-3-text", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("apache-notice", "Apache-2.0", ["apache-ref-2", "apache-use", "apache-copy"]),
    ("isc-text", "ISC", ["isc-grant", "as-is"]),
    ("gpl3-notice", "GPL-3.0-or-later", ["gpl-free", "gpl-warranty"]),
    ("gpl2-notice", "GPL-2.0-or-later", ["gpl2-free", "gpl-warranty"]),
    ("agpl3-notice", "AGPL-3.0-or-later", ["agpl-free", "gpl-warranty"]),
    ("lgpl2-notice", "LGPL-2.1-or-later", ["lgpl-free", "lgpl-warranty"]),
    ("mpl-notice", "MPL-2.0", ["mpl-ref"]),
    ("unlicense-text", "Unlicense", ["unlicense-free", "unlicense-use"]),
    ("zlib-text", "Zlib", ["zlib-as-is", "zlib-damages", "zlib-grant"]),
    ("boost-reference", "BSL-1.0", ["boost-ref"]),
]

#: A sentence ends before white space at . ! ? : ; and at a line's end; in the wrapped reading only an empty line ends it.
_ENDS = r"[.!?:;]+(?=\s|$)|\n+"
_WRAPPED_ENDS = r"[.!?:;]+(?=\s|$)|\n\s*\n"


def normalised(text: Column) -> Column:
    """Letters and digits in lower case, all else one space; the same for texts and for known sentences."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _known(text: str) -> str:
    """What normalised() makes of a known sentence, on the driver."""
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def _anchors(parts: list[str]) -> str:
    """A pattern that every part matches: few words that cover all of them."""
    left, chosen = [set(p.split()) for p in parts], []
    while left:
        words = {w for p in left for w in p}
        best = max(words, key=lambda w: (sum(w in p for p in left), len(w), w))
        chosen.append(best)
        left = [p for p in left if best not in p]
    return "|".join(map(re.escape, chosen)) or "$^"


def scan(docs: DataFrame, text: str = "text", known: dict[str, str] | None = None, rules: list[tuple[str, str, list[str]]] | None = None) -> DataFrame:
    """docs and n_sentences int, sentence_ids array<string>, matched_rules array<string>, licenses array<string>.

    These four replace columns of the same names. A known sentence with an ending inside counts by its parts id#0, id#1...
    """
    known, rules = known or SENTENCES, rules or RULES
    parts: dict[str, str] = {}
    order: dict[str, list[str]] = {}
    for k, s in known.items():
        pieces = [p for p in map(_known, re.split(_ENDS, s)) if p]
        for i, p in enumerate(pieces):
            parts.setdefault(p, k if len(pieces) == 1 else f"{k}#{i}")
        order[k] = [parts[p] for p in pieces]
    n_buckets = 1 << max(0, len(parts).bit_length() - 2)
    buckets: list[list[str]] = [["", ""] for _ in range(n_buckets)]  # no sentence is empty
    for p, k in parts.items():
        buckets[zlib.crc32(p.encode()) % n_buckets] += [p, k]
    table = F.array(*[F.create_map(*map(F.lit, b)) for b in buckets])
    lookup = lambda s: F.element_at(F.get(table, (F.crc32(F.encode(s, "UTF-8")) % n_buckets).cast("int")), s)
    anchors, longest = _anchors(list(parts)), max(map(len, parts))
    whole = F.coalesce(F.col(text), F.lit(""))

    def ids(of: Column) -> Column:
        near = F.transform(F.filter(of, lambda s: F.lower(s).rlike(anchors)), normalised)
        return F.filter(F.transform(near, lambda s: F.when(F.length(s) <= longest, lookup(s))), lambda x: x.isNotNull())

    none = F.array().cast("array<string>")
    maybe = F.lower(whole).rlike(anchors)
    chain = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    out = docs.withColumn("n_sentences", F.size(F.filter(F.split(whole, _ENDS), lambda s: s.rlike(r"[\p{L}\p{N}]"))))
    out = out.withColumn("__lines", F.when(maybe, ids(F.split(whole, _ENDS))).otherwise(none))
    out = out.withColumn("__wrapped", F.when(maybe, ids(F.split(whole, _WRAPPED_ENDS))).otherwise(none))
    table_of_rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(lic).alias("license"), F.lit(" " + " ".join(x for i in seq for x in order[i]) + " ").alias("seq")) for r, lic, seq in rules])
    out = out.withColumns({"__a": chain("__lines"), "__b": chain("__wrapped")})

    def longest_only(hits: Column) -> Column:
        return F.filter(hits, lambda r: ~F.exists(hits, lambda o: (F.length(o["seq"]) > F.length(r["seq"])) & o["seq"].contains(r["seq"])))

    fitting = let(F.filter(table_of_rules, lambda r: F.col("__a").contains(r["seq"]) | F.col("__b").contains(r["seq"])), longest_only)
    out = out.withColumn("__hits", F.when((F.size("__lines") > 0) | (F.size("__wrapped") > 0), fitting))
    pick = lambda name: F.coalesce(F.array_sort(F.array_distinct(F.transform("__hits", lambda r: r[name]))), none)
    out = out.withColumn("sentence_ids", F.when(F.size("__wrapped") > F.size("__lines"), F.col("__wrapped")).otherwise(F.col("__lines")))
    return out.withColumns({"matched_rules": pick("rule"), "licenses": pick("license")}).drop("__lines", "__wrapped", "__a", "__b", "__hits")
