"""License scan by MinHash bands over overlapping text windows (operator 4).

Each text is cut into windows of twice a template's length, overlapping by half, so a copy of a template
lies whole in some window and makes up about half of its shingles. Bands of one MinHash value each
retrieve the templates that may be in a window; with BANDS bands a similarity s is met with a probability
of 1 - (1 - s)^BANDS, 0.9996 at s = 0.2. Exact containment of the template's shingles then decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import free_name, hashed_words, map_batches, shingled, text_blocks

SHINGLE_WORDS, CONTAINMENT, BANDS = 5, 0.8, 35

# Opening words of public licences, and the usual one-line statements of them.
TEMPLATES: dict[str, str] = {
    "MIT": "Released under the MIT License.",
    "MIT (grant)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (notice)": "you may not use this file except in compliance with the License. You may obtain a copy of "
    "the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL (notice)": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation",
    "LGPL (notice)": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
    "as published by the Free Software Foundation",
    "BSD (conditions)": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_MULTIPLIERS = np.random.default_rng(11).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


@dataclass
class _Templates:
    names: list[str]
    shingles: list[np.ndarray]  # distinct, sorted
    lengths: list[int]  # in shingles, repeats included
    levels: dict[int, list[int]]  # templates by the power of two that holds their length
    values: dict[int, list[np.ndarray]]  # MinHash values of a level's templates, one array per band
    k: int


def min_hashes(shingles: np.ndarray, bands: int) -> np.ndarray:
    """Permuted shingles, one row per band: the upper half of a product by an odd number."""
    return ((shingles[None, :] * _MULTIPLIERS[:bands, None]) >> np.uint64(32)).astype(np.uint32)


def build_templates(templates: Mapping[str, str], k: int = SHINGLE_WORDS, bands: int = BANDS) -> _Templates:
    names, shingles, lengths, levels = [], [], [], {}
    for name, text in templates.items():
        data = np.frombuffer(text.encode(), np.uint8)
        h, _, _ = shingled(hashed_words(data, np.array([0, len(data)])), k)
        if len(h):
            levels.setdefault(1 << (len(h) - 1).bit_length(), []).append(len(names))
            names.append(name)
            shingles.append(np.unique(h))
            lengths.append(len(h))
    values = {
        level: [np.array([min_hashes(shingles[i], bands)[b].min() for i in members]) for b in range(bands)]
        for level, members in levels.items()
    }
    return _Templates(names, shingles, lengths, levels, values, k)


def _candidates(h: np.ndarray, t: _Templates, bands: int) -> dict[int, list[np.ndarray]]:
    """For each template the first shingles of windows that share a band with it."""
    found: dict[int, list[np.ndarray]] = {}
    for band in range(bands):
        low = ((h * _MULTIPLIERS[band]) >> np.uint64(32)).astype(np.uint32)
        length = 1  # blocks of `length` shingles, then windows of two blocks
        for level in sorted(t.levels):
            while length < level:
                if len(low) % 2:
                    low = np.append(low, np.uint32(0xFFFFFFFF))
                low = low.reshape(-1, 2).min(axis=1)
                length *= 2
            windows = np.minimum(low[:-1], low[1:]) if len(low) > 1 else low
            for member, value in zip(t.levels[level], t.values[level][band].tolist(), strict=True):
                at = np.flatnonzero(windows == np.uint32(value))
                if len(at):
                    found.setdefault(member, []).append(at * level)
    return found


def licenses_of(texts: pa.Array, t: _Templates, containment: float, bands: int) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    for first, _, data, offsets in text_blocks(texts):
        words = hashed_words(data, offsets)
        h, doc, word = shingled(words, t.k)
        starts = np.searchsorted(words.doc, np.arange(len(offsets)))
        for member, places in sorted(_candidates(h, t, bands).items() if len(h) else ()):
            level = 1 << (t.lengths[member] - 1).bit_length()
            best: dict[int, tuple[float, int]] = {}
            for at in np.unique(np.concatenate(places)).tolist():
                window, owner = h[at : at + 2 * level], doc[at : at + 2 * level]
                hit = np.isin(window, t.shingles[member])
                for d in np.unique(owner[hit]).tolist():  # a window may reach into the next text
                    own = hit & (owner == d)
                    share = len(np.unique(window[own])) / len(t.shingles[member])
                    begin = at + int(np.flatnonzero(own)[0])
                    if share >= containment and (share, -begin) > best.get(d, (0.0, 0)):
                        best[d] = (share, -begin)
            for d, (share, begin) in best.items():
                place = int(word[-begin] - starts[d])
                out[first + d].append({"license": t.names[member], "containment": share, "first_word": place})
    return out


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] | None = None,
    text: str = "text",
    containment: float = CONTAINMENT,
    k: int = SHINGLE_WORDS,
    bands: int = BANDS,
    licenses: str = "licenses",
) -> DataFrame:
    """``docs`` with a further column ``licenses``: name, containment, first word of the best match of each.

    ``templates`` maps names to texts, a dictionary and so bounded; it is sent with the tasks. Templates of
    fewer than ``k`` words match nothing. Words are runs of ASCII letters and digits (case-insensitive) and
    of other non-ASCII characters. Null and empty texts have no licence. All columns of ``docs`` pass
    through; if ``licenses`` is taken, licenses_2 is used.
    """
    if bands > len(_MULTIPLIERS):
        raise ValueError(f"at most {len(_MULTIPLIERS)} bands")
    built = build_templates(TEMPLATES if templates is None else templates, k, bands)
    name, columns = free_name(docs.columns, licenses), docs.columns
    at = [c.lower() for c in columns].index(text.lower())
    kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first_word", pa.int64())]))

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = licenses_of(batch.column(at), built, containment, bands)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*columns, name])

    schema = docs.select(
        "*", F.lit(None).cast("array<struct<license:string,containment:double,first_word:bigint>>").alias(name)
    ).schema
    return map_batches(docs, scan, schema)
