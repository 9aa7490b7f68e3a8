"""Licence scans: sparse TF-IDF cosine to licence templates, then inheritance from the nearest ancestor directory.

Two kinds of templates: headers and notices, which a stretch of a text is compared with, and whole licences, which a text as a whole is
compared with (short ones are searched for as stretches too). Clauses tell relatives apart: a template may need words in the stretch or phrases in the text, or exclude them.
A line with an SPDX identifier says its licence itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from ..runtime import Workspace
from .arrow import append, pieces, texts_of

#: Public texts of whole licences, one file each, named by their SPDX identifiers.
TEXTS = Path(__file__).resolve().parent / "license_texts"
#: Headers and notices of common licences, and words that a stretch must hold to be taken for one (versions, and what tells relatives apart).
HEADERS = (
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information.", "mit"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.", "sublicense"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache 2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "general 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "general 2"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "general 3"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "general 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", "lesser 3"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1.", "lesser 2.1"),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.", "lesser 3"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lesser 2.1"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", "affero 3"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "affero 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "bsd"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License.", "bsd 2"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License.", "bsd 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "fee"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "nc 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "noncommercial 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "sa 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "sharealike 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "attribution 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal.", "waived"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions", "alter"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.", "boost 1.0"),
    ("Proprietary", "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited. Proprietary and confidential.", "proprietary"),
)
#: Phrases that a text must have, and those that it can't have, to be under a licence rather than its relatives.
CLAUSES = {
    "BSD-3-Clause": (("endorse or promote", "bsd style", "3 clause"), ("advertising materials mentioning",)), "BSD-2-Clause": ((), ("endorse or promote", "3 clause")), "AGPL-3.0": (("affero general public license",), ()),
    "CC-BY-4.0": ((), ("noncommercial", "sharealike", "by nc", "by sa", "noderivatives")), "CC-BY-NC-4.0": ((), ("sharealike", "nc sa")),
}
#: Words of which every template has one: a stretch without any isn't near enough to any template (checked when the index is built).
CUES = frozenset("license licensed licence licenced copyright redistribution permission spdx unencumbered cc".split())
#: Least cosines of a stretch and of a whole text; share of a text that a stretch must be for the text to be a licence file; words of the longest whole licence that is searched for as a stretch too.
LEAST, WHOLE, FILE_SHARE, STRETCH_WORDS = 0.75, 0.9, 0.4, 300
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_SPDX = re.compile(r"(?i)\bspdx-license-identifier:[ \t]*\(?([a-z0-9.+-]+(?:[ \t]+(?:or|and|with)[ \t]+[a-z0-9.+-]+)*)")
_LATER = re.compile(r"(-only|-or-later|\+)$", re.IGNORECASE)


@dataclass(frozen=True)
class Template:
    name: str
    size: int
    vector: dict[str, float]  # of length one
    must: tuple[str, ...]  # words of a stretch
    whole: bool


class Templates:
    """Sparse TF-IDF vectors of the templates, each of length one. `headers`: (name, text, words that a stretch must hold); `wholes`: texts by name."""

    def __init__(self, headers=HEADERS, wholes: dict[str, str] | None = None, least: float = LEAST, clauses: dict = CLAUSES):
        wholes = {} if wholes is None else wholes
        listed = [(name, _WORD.findall(text.lower()), tuple(must.split()), False) for name, text, must in headers]
        listed += [(name, _WORD.findall(text.lower()), (), True) for name, text in sorted(wholes.items())]
        df = Counter(w for _, ws, _, _ in listed for w in set(ws))
        n = len(listed)
        self.least, self.clauses = least, clauses
        self.unseen = math.log((1 + n) / 1) + 1
        self.idf = {w: math.log((1 + n) / (1 + c)) + 1 for w, c in df.items()}
        self.names = {name.lower(): name for name, *_ in listed}
        self.templates = []
        for name, ws, must, whole in listed:
            raw = {w: k * self.idf[w] for w, k in Counter(ws).items()}
            norm = math.sqrt(sum(v * v for v in raw.values()))
            if not CUES & raw.keys():
                raise ValueError(f"a template without a cue: {name}")
            self.templates.append(Template(name, len(ws), {w: v / norm for w, v in raw.items()}, must, whole))
        self.stretches = [t for t in self.templates if not t.whole or t.size <= STRETCH_WORDS]

    def allowed(self, name: str, text: str) -> bool:
        """Whether a text (words with single blanks, one at either end) has the phrases that the licence needs and none that it can't have."""
        some, none = self.clauses.get(name, ((), ()))
        return (not some or any(f" {p} " in text for p in some)) and not any(f" {p} " in text for p in none)

    def best(self, words: list[str]) -> tuple[str | None, float, int]:
        """(licence, cosine, words of the stretch) of the best stretch with a cue; ties go to the template listed first, then to the first stretch."""
        cues = np.flatnonzero([w in CUES for w in words])
        top: tuple[str | None, float, int] = (None, 0.0, 0)
        if not len(cues):
            return top
        text = f" {' '.join(words)} "
        stretches = [t for t in self.stretches if self.allowed(t.name, text)]
        reach = max((t.size for t in stretches), default=0)
        # only the words around cues are looked at, however long the text is
        border = np.flatnonzero(np.diff(cues) > 2 * reach) + 1
        for held in np.split(cues, border):
            low, high = max(0, int(held[0]) - reach), min(len(words), int(held[-1]) + reach + 1)
            top = self._best_near(words[low:high], held - low, stretches, len(words), top)
        return top if top[1] >= self.least else (None, top[1], top[2])

    def _best_near(self, words: list[str], cues: np.ndarray, stretches: list[Template], n: int, top: tuple[str | None, float, int]) -> tuple[str | None, float, int]:
        weights = np.array([self.idf.get(w, self.unseen) for w in words])
        squares = np.concatenate([[0.0], np.cumsum(weights**2)])
        for t in stretches:
            size = min(t.size, n)
            # every stretch of the template's length that holds a cue; the square sum of its words' weights bounds its norm from below
            near = np.zeros(len(words) + 1, np.int64)
            np.add.at(near, np.maximum(cues - size + 1, 0), 1)
            np.add.at(near, np.minimum(cues, len(words) - size) + 1, -1)
            starts = np.flatnonzero(np.cumsum(near)[:-1] > 0)
            dots = np.concatenate([[0.0], np.cumsum([t.vector.get(w, 0.0) for w in words] * weights)])
            dot = dots[starts + size] - dots[starts]
            bound = dot / np.sqrt(squares[starts + size] - squares[starts])
            for k in np.flatnonzero(bound > top[1] + 1e-12).tolist():
                if bound[k] <= top[1] + 1e-12:
                    continue
                stretch = words[starts[k] : starts[k] + size]
                if any(m not in stretch for m in t.must):
                    continue
                norm = math.sqrt(sum((c * self.idf.get(w, self.unseen)) ** 2 for w, c in Counter(stretch).items()))
                if dot[k] / norm > top[1] + 1e-12:
                    top = (t.name, min(1.0, float(dot[k] / norm)), size)
        return top

    def whole(self, words: list[str]) -> tuple[str | None, float]:
        """(licence, cosine) of the whole licence that a text is nearest to."""
        counts = Counter(words)
        raw = {w: c * self.idf.get(w, self.unseen) for w, c in counts.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        text = f" {' '.join(words)} "
        found = [(min(1.0, sum(v * raw.get(w, 0.0) for w, v in t.vector.items()) / norm), t.name) for t in self.templates if t.whole and 2 * t.size >= len(words) >= t.size // 2]
        score, name = max(((s, n) for s, n in found if s >= WHOLE and self.allowed(n, text)), default=(max(found, default=(0.0, ""))[0], None))
        return name, score

    def match(self, text: str) -> tuple[str | None, float, bool]:
        """(licence, score, whether the text is a licence file). An SPDX line counts before anything else, then the whole text, then the best stretch."""
        lower = text.lower()
        if not _CUE.search(lower):
            return None, 0.0, False
        words = _WORD.findall(lower)
        if not words:
            return None, 0.0, False
        name, score = self.whole(words)
        if name:
            return name, score, True
        if said := _SPDX.search(text):
            known = [w if w.lower() in ("or", "and", "with") else self.names.get(_LATER.sub("", w).lower(), w) for w in said[1].split()]
            return " ".join(w.upper() if w.lower() in ("or", "and", "with") else w for w in known), 1.0, len(_WORD.findall(said[0].lower())) >= FILE_SHARE * len(words)
        name, score, size = self.best(words)
        return name, score, name is not None and size >= FILE_SHARE * len(words)


@lru_cache(maxsize=1)
def default_templates() -> Templates:
    """The headers and all whole licences. Made on the driver and sent to the workers, which need no files."""
    return Templates(wholes={path.stem: path.read_text() for path in sorted(TEXTS.glob("*.txt"))})


_CUE = re.compile("|".join(sorted(CUES)))


def match_licenses(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, templates: Templates | None = None) -> DataFrame:
    """df plus license (an SPDX identifier or expression; null where nothing is near enough), license_score and license_file (the text is a whole licence, or the stretch found is FILE_SHARE of it or more).

    Whole texts are read, of any length. Null, empty and wordless texts have no licence and score 0. Repeated rows are matched each; an empty table gives an empty result; clashing columns are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(templates or default_templates())  # as large as the templates, whatever the input

    def compute(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for rows in pieces(batch, text_col, 4 << 20):
                found = [shared.value.match(text) for text in texts_of(rows.column(text_col))]
                yield rows, [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.bool_())]

    return append(df, [StructField("license", StringType()), StructField("license_score", DoubleType()), StructField("license_file", BooleanType())], compute, keep)


def inherit_licenses(df: DataFrame, path_col: str = "path") -> DataFrame:
    """df plus effective_license, license_origin (own, inherited or none) and license_dir (the directory it comes from).

    A file with a licence keeps it. Any other has that of the nearest directory above it with a licence file (license_file, from `match_licenses`); among several there, the highest score, then the first path.
    The matched rows are written once for the three uses of them. Paths are joined by directory, not by file: a directory's ancestors are looked up once for all its files. A null path inherits nothing. Clashing columns are replaced; repeated rows stay; an empty table gives an empty result.
    """
    new = ("effective_license", "license_origin", "license_dir")
    files = Workspace(df.sparkSession).write(df.drop(*new).withColumn("__dir", F.regexp_replace(F.col(path_col), "/[^/]*$", "")), "matched")
    held = files.where("license_file AND __dir IS NOT NULL").groupBy("__dir").agg(F.min_by("license", F.struct(-F.col("license_score"), F.col(path_col))).alias("__license"))
    wanted = files.where("license IS NULL AND __dir IS NOT NULL").select("__dir").distinct()
    depth = "size(split(__dir, '/'))"
    above = wanted.select("__dir", F.explode(F.expr(f"transform(sequence(1, {depth}), k -> array_join(slice(split(__dir, '/'), 1, k), '/'))")).alias("__above"))
    nearest = above.join(held.withColumnRenamed("__dir", "__above"), "__above").groupBy("__dir").agg(F.max_by(F.struct("__license", "__above"), F.length("__above")).alias("__near"))
    own = F.col("license").isNotNull()
    return (
        files.join(nearest, "__dir", "left")
        .withColumns({
            "effective_license": F.coalesce("license", "__near.__license"),
            "license_origin": F.when(own, "own").when(F.col("__near").isNotNull(), "inherited").otherwise("none"),
            "license_dir": F.when(own, F.col("__dir")).otherwise(F.col("__near.__above")),
        })
        .drop("__dir", "__near")
    )
