"""Licence notices in documents by conditional compression.

Around each cue word, per notice, a block of about the notice's length is cut, across line ends: the words that stand where the
notice would if the cue were its own, and some more on both sides: few, so that notices that follow each other
stay apart, and again more, for notices with words put in. The words of the block are compressed
alone and with the notice as a raw zstandard dictionary; what is saved is judged against the compressed size of the
notice itself, so the text around a notice does not matter. Every notice above the limit is confirmed by the exact
word differences between notice and block: compression never decides alone.

The notices are a fixed short list shipped with the code; nothing else is broadcast, and there is no shuffle.

Defined cases: null and empty texts have no blocks; the same notice in several places gives a finding each, with the line it
begins in; exact notices are all kept, also one inside another; a changed notice most of whose words belong to a
better finding (fewer differences for its length, then more saved, then the first by name) is none; repeated rows are documents of their own.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import slices, utf8

# Wordings of common notices.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                         "in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
               "to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the "
                      "License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "reserved": "All rights reserved.",
}
CUES = re.compile(r"licen[cs]|copyright|rights\W+reserved|redistribution|permission\W+is\W+hereby|public\W+domain", re.I)
_CUES_UTF8 = re.compile(CUES.pattern.encode(), re.I)
LEVEL = 9
# A notice must save this part of its own compressed size in the block to be compared word by word ...
MIN_SAVED = 0.2
# ... and this part of the notice's words must stand in the block, in order.
MIN_WORDS = 0.8
_RUN = re.compile(r"[\w.+-]+")
FINDING = ("struct<line:int,licence:string,saved:double,same_words:double,exact:boolean,"
           "missing:array<string>,added:array<string>>")


def _words(text: str) -> list[tuple[int, str]]:
    """Words, each with the place it begins at."""
    return [(m.start(), word.lower()) for m in _RUN.finditer(text) if (word := m[0].rstrip(".+-"))]


def _cues(words: list[str]) -> list[int]:
    """Numbers of the words at which cues begin."""
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    return sorted({bisect_right(starts, m.start()) - 1 for m in CUES.finditer(" ".join(words))})


class Scanner:
    def __init__(self, notices: dict[str, str]):
        self.alone = zstandard.ZstdCompressor(level=LEVEL)
        self.notices = []
        for name, text in sorted(notices.items()):
            words = [w for _, w in _words(text)]
            plain, slack, cues = " ".join(words).encode(), max(2, len(words) // 2), []
            for at in _cues(words):
                # Blocks of cues that stand close together are nearly the same.
                if not cues or at - cues[-1] > slack // 2:
                    cues.append(at)
            known = zstandard.ZstdCompressionDict(plain, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.notices.append((name, words, [(at, more) for at in cues for more in (slack, 2 * slack + 8)], len(self.alone.compress(plain)),
                                 zstandard.ZstdCompressor(level=LEVEL, dict_data=known)))

    def block(self, notice: int, words: list[str], start: int) -> tuple[dict, list[int], float] | None:
        """What a block that begins at word ``start`` holds of a notice, the numbers of those words, and how much differs."""
        name, wanted, _, size, with_notice = self.notices[notice]
        plain = " ".join(words).encode()
        saved = (len(self.alone.compress(plain)) - len(with_notice.compress(plain))) / size
        if saved < MIN_SAVED:
            return None
        changes = SequenceMatcher(None, wanted, words, autojunk=False).get_opcodes()
        equal = [start + i for what, _, _, a, b in changes if what == "equal" for i in range(a, b)]
        same = len(equal) / len(wanted)
        if same < MIN_WORDS:
            return None
        missing, added = [], []
        for number, (what, a, b, c, d) in enumerate(changes):
            if what == "equal":
                continue
            # Words before and after the notice belong to the text around it, but for those that stand for missing ones.
            if number == 0:
                c = max(c, d - (b - a))
            if number == len(changes) - 1:
                d = min(d, c + (b - a))
            missing += wanted[a:b]
            added += words[c:d]
        return {"licence": name, "saved": round(saved, 6), "same_words": round(same, 6),
                "exact": not missing and not added, "missing": missing, "added": added}, equal, (len(missing) + len(added)) / len(wanted)

    def scan(self, text: bytes | None) -> list[dict]:
        if not text or not _CUES_UTF8.search(text):
            return []
        page = text.decode("utf-8", "replace")
        places = _words(page)
        words = [w for _, w in places]
        hits = []
        for cue in _cues(words):
            for i, (_, wanted, cues, _, _) in enumerate(self.notices):
                for at, slack in cues:
                    start = max(0, cue - at - slack)
                    block = words[start:max(0, cue - at + len(wanted) + slack)]
                    if len(block) >= MIN_WORDS * len(wanted) and (hit := self.block(i, block, start)):
                        hits.append(hit)
        if not hits:
            return []
        hits.sort(key=lambda x: (x[2], -x[0]["saved"], x[0]["licence"], x[1][0]))
        kept, owners = [], {}
        for hit, own, _ in hits:
            shared = Counter(k for w in own for k in owners.get(w, ()))
            if any(kept[k][1]["licence"] == hit["licence"] or not hit["exact"] and 2 * n > len(own) for k, n in shared.items()):
                continue
            for w in own:
                owners.setdefault(w, []).append(len(kept))
            kept.append((own[0], hit))
        ends = [m.start() for m in re.finditer("\n", page)]
        return [{"line": bisect_right(ends, places[first][0])} | hit
                for first, hit in sorted(kept, key=lambda x: (x[0], x[1]["licence"]))]


_FINDING = pa.struct([("line", pa.int32()), ("licence", pa.string()), ("saved", pa.float64()),
                      ("same_words", pa.float64()), ("exact", pa.bool_()), ("missing", pa.list_(pa.string())),
                      ("added", pa.list_(pa.string()))])


def _scan(notices: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for part in slices(batches):
            found = [scanner.scan(x.as_py()) for x in part["_utf8"]]
            yield pa.RecordBatch.from_arrays([part["_row"], pa.array(found, pa.list_(_FINDING))],
                                             names=["_row", "findings"])
    return run


def scan_licences(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """``_row`` (all columns of ``docs``) and ``findings``, one per place of a confirmed notice."""
    rows = docs.select(F.struct("*").alias("_row"), utf8("text").alias("_utf8"))
    return rows.mapInArrow(
        _scan(notices), f"_row {rows.schema['_row'].dataType.simpleString()}, findings array<{FINDING}>")


def report(docs: DataFrame) -> DataFrame:
    return scan_licences(docs.select("doc_id", "text")).select(
        "_row.doc_id", F.size("findings").cast("long").alias("n_findings"),
        F.array_join(F.array_sort(F.array_distinct("findings.licence")), ",").alias("licences"), "findings")
