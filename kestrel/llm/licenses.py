"""Licence scans by a positional rare-token index (operator 2).

The library of licence texts is indexed by its rarest words: each template posts the positions of
its ``RARE`` highest-IDF words (IDF over the library).  A file looks up those of its words that
the index holds; postings are intersected by relative position, so that words which agree on one
start of a template vote for it.  A start with enough votes is kept if one of the template's
key phrases stands there word by word.

Everything happens inside the row, on arrays of the file's rare words: no shuffle, and no table
but the library, which is part of the plan.  Sorting replaces pairwise comparison, so a text that
repeats one cue word costs n log n.

Defined cases: NULL text counts as empty (0 words, no label, score 0); overlapping places all
count; repeated rows give equal results; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.words import whole

# Fixed values: (label, text, mandatory key phrase) of the phrases that are always looked for ...
BASE = [
    ("mit", "mit license", "mit license"),
    ("apache", "apache license", "apache license"),
    ("gpl", "general public license", "general public license"),
]
# ... and of passages that identify further licences, or the same ones without their name; of several
# key phrases one is enough, so a changed word hides no licence.
PASSAGES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files",
     "free of charge to any person obtaining a copy", "this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met",
     "redistribution and use in source and binary forms", "permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted",
     "distribute this software for any purpose with or without fee", "permission to use copy modify and or distribute"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license",
     "mozilla public license", "this source code form is subject to the terms"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software", "software released into the public domain"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("cc-by", "licensed under the creative commons attribution license", "creative commons attribution"),
    ("cc0", "waived all copyright and related or neighboring rights to",
     "waived all copyright and related", "related or neighboring rights to"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the "
            "free software foundation",
     "as published by the free software foundation", "under the terms of the gnu general public license"),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public license as published "
             "by the free software foundation",
     "gnu lesser general public license", "the terms of the gnu lesser", "lesser general public license as published"),
    ("agpl", "redistribute it and or modify it under the terms of the gnu affero general public license as published "
             "by the free software foundation",
     "gnu affero general public license", "the terms of the gnu affero", "affero general public license as published"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
               "compliance with the license",
     "you may not use this file except in compliance with the license", "licensed under the apache license version 2 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public "
            "license", "eclipse public license", "this program and the accompanying materials are made available"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be "
             "held liable for any damages arising from the use of this software",
     "in no event will the authors be held liable", "as is without any express or implied warranty"),
    ("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software "
            "and accompanying documentation covered by this license",
     "any person or organization obtaining a copy", "accompanying documentation covered by this license"),
    ("artistic", "state the conditions under which a package may be copied such that the copyright holder maintains "
                 "some semblance of artistic control over the development of the package",
     "some semblance of artistic control", "conditions under which a package may be copied"),
]
RARE = 6   # words of a passage that are indexed
VOTES = 4  # of them, that must agree on one start

# ASCII characters that separate words, listed one by one (see words.SPACE)
SEPARATORS = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum() or chr(c).isupper()) + "]+"
P = "_c_"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]  # (position, words) of the key phrases
    rare: tuple[tuple[str, int], ...]  # (word, position)
    votes: int


def build_library(base=tuple(BASE), passages=tuple(PASSAGES), rare: int = RARE, votes: int = VOTES) -> list[Template]:
    """The templates with their indexed words; the first ``len(base)`` are the base phrases."""
    texts = [t.split() for _, t, *_ in (*base, *passages)]
    holders = Counter(w for t in texts for w in set(t))
    idf = {w: math.log(len(texts) / n) for w, n in holders.items()}
    out = []
    for i, (label, text, *keys) in enumerate((*base, *passages)):
        ws = text.split()
        once = [w for w in ws if ws.count(w) == 1]  # a word at one position votes for one start
        ranked = sorted(once, key=lambda w: (-idf[w], -len(w), w))
        picked = ranked[:1 if i < len(base) else rare]
        at = [next(j for j in range(len(ws)) if ws[j:j + len(k.split())] == k.split()) for k in keys]
        out.append(Template(label, tuple(ws), tuple((j, tuple(k.split())) for j, k in zip(at, keys)),
                            tuple((w, ws.index(w)) for w in picked), min(len(picked), 1 if i < len(base) else votes)))
    return out


LIBRARY = build_library()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z.  ``lower`` does that too, but maps two more characters into ASCII."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    odd = F.contains(text, F.lit("K")) | F.contains(text, F.lit("İ"))
    return F.when(odd, F.translate(text, letters, letters.lower())).otherwise(F.lower(text))


def _literal_words(ws: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, ws))


def scan(docs: DataFrame, library: list[Template] | None = None, n_base: int = len(BASE)) -> DataFrame:
    """(doc_id, n_words, matches) per row; matches: array of (template, start, votes) in order.

    ``n_base`` plays no part in the scan: base phrases are templates with one indexed word.
    """
    library = LIBRARY if library is None else library
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(library):
        for w, at in template.rare:
            postings.setdefault(w, []).append((t, at))
    posted = F.create_map(*[x for w, ps in postings.items() for x in (F.lit(w), F.array(*[
        F.struct(F.lit(t).alias("t"), F.lit(at).alias("at")) for t, at in ps]))])
    w = F.col(P + "w")
    rows = docs.select("doc_id", F.array_remove(F.split(ascii_lower(whole(F.col("text"))), SEPARATORS), "")
                       .alias(P + "w"))
    hits = F.array_compact(F.transform(w, lambda x, i: F.when(x.isin(list(postings)), F.struct(
        x.alias("w"), i.alias("i")))))
    rows = rows.select("doc_id", P + "w", F.size(w).cast("long").alias("n_words"), hits.alias(P + "h"))
    # one (template, start) per posting, sorted: equal ones are votes for one place
    places = F.sort_array(F.flatten(F.transform(P + "h", lambda h: F.transform(
        F.element_at(posted, h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["at"]).alias("start"))))))
    rows = rows.withColumn(P + "p", F.when(F.size(P + "h") > 0, places))
    p = F.col(P + "p")
    none = F.lit(None).cast("struct<t:int,start:int>")

    def moved(by: int) -> Column:
        """The place ``by`` positions later, or earlier where negative (NULL beyond the ends)."""
        if by < 0:
            return F.concat(F.array(none), p)
        return F.concat(F.slice(p, F.lit(by + 1), F.size(p)), F.array_repeat(none, by))

    most = max(len(t.rare) for t in library)  # votes that one place can get
    lined = F.arrays_zip(moved(-1).alias("before"), *[moved(k).alias(f"p{k}") for k in range(max(most, 2))])
    first = F.filter(lined, lambda x: x["p0"].isNotNull() & ~x["p0"].eqNullSafe(x["before"]))

    def votes(x: Column) -> Column:
        return sum((F.when(x["p0"].eqNullSafe(x[f"p{k}"]), 1).otherwise(0) for k in range(1, most)), F.lit(1))

    counted = F.transform(first, lambda x: F.struct(
        x["p0"]["t"].alias("t"), x["p0"]["start"].alias("start"), votes(x).alias("votes")))
    need = F.array(*[F.lit(t.votes) for t in library])
    keys = F.array(*[F.array(*[F.struct(F.lit(at).alias("at"), _literal_words(k).alias("words")) for at, k in t.keys])
                     for t in library])
    enough = F.filter(counted, lambda c: c["votes"] >= F.element_at(need, c["t"] + 1))
    # a key phrase, word by word; both array columns were materialised above
    sure = F.filter(enough, lambda c: F.exists(F.element_at(keys, c["t"] + 1), lambda k: (c["start"] + k["at"] >= 0) & (
        F.slice(w, F.greatest(c["start"] + k["at"], F.lit(0)) + 1, F.size(k["words"])) == k["words"])))
    empty = F.array().cast("array<struct<t:int,start:int,votes:int>>")
    return rows.select("doc_id", "n_words", F.size(w).alias(P + "n"), F.when(
        F.size(p) > 0, sure).otherwise(empty).alias("matches"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the best share of a matched template's indexed words that voted (0 without any).
    """
    found = scan(docs).withColumn(P + "b", F.filter("matches", lambda m: m["t"] < len(BASE)))
    labels = F.array(*[F.lit(t.label) for t in LIBRARY])
    total = F.array(*[F.lit(len(t.rare)) for t in LIBRARY])

    def joined(matches: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(
            matches, lambda m: F.element_at(labels, m["t"] + 1)))), ",")

    starts = F.transform(P + "b", lambda m: m["start"].cast("long"))
    shares = F.transform("matches", lambda m: m["votes"] / F.element_at(total, m["t"] + 1))
    return found.select(
        "doc_id", "n_words", F.size(P + "b").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(P + "b").alias("base_labels"),
        joined("matches").alias("labels"), F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"))
