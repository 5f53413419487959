"""License detection by ordered signature rules.

Each rule is a regular expression with a priority and the words that must
occur before it is tried.  Detections are resolved from the highest priority
down: one that lies inside an accepted detection of a higher priority, or
inside a longer one of its own priority, is suppressed.  Base phrases are
counted apart and never suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.llm.text import ALNUM, LOWER, Tokens, chunks, raw_bytes, tokenise, word_hash

#: Phrase, label.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Label, the word that must occur (one of ``a|b``), how the license is named, versions.
FAMILIES = (
    ("afl", "academic", r"academic free licen[cs]e", "1.1 1.2 2.0 2.1 3.0"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e", "1.0 3.0"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e", "1.0 1.1 2.0"),
    ("apsl", "apple", r"apple public source licen[cs]e", "1.0 1.1 1.2 2.0"),
    ("artistic", "artistic", r"(?:perl )?artistic licen[cs]e", "1.0 2.0"),
    ("boost", "boost", r"boost software licen[cs]e", "1.0"),
    ("bsd-0-clause", "bsd", r"(?:zero[- ]clause bsd|bsd zero[- ]clause) licen[cs]e", ""),
    ("bsd-2-clause", "bsd|freebsd", r"(?:simplified bsd|bsd 2[- ]clause|2[- ]clause bsd|freebsd) licen[cs]e", ""),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3[- ]clause|3[- ]clause bsd) licen[cs]e", ""),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4[- ]clause|4[- ]clause bsd) licen[cs]e", ""),
    ("bsd", "bsd", r"bsd[- ](?:style )?licen[cs]e", ""),
    ("cc-by", "creative", r"creative commons attribution(?: international| unported| generic)?(?: licen[cs]e)?", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc", "creative", r"creative commons attribution[- ]noncommercial", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution[- ]noncommercial[- ]noderivatives", "3.0 4.0"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution[- ]noncommercial[- ]sharealike", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nd", "creative", r"creative commons attribution[- ]noderivatives", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-sa", "creative", r"creative commons attribution[- ]sharealike", "1.0 2.0 2.5 3.0 4.0"),
    ("cc0", "cc0|cc01|cc0v|cc0v1|cc0version", r"cc0(?: universal)?(?: public domain dedication)?", "1.0"),
    ("cddl", "distribution", r"common development and distribution licen[cs]e", "1.0 1.1"),
    ("cecill", "cecill", r"cecill(?:-[abc])? (?:free software )?licen[cs]e", "1.0 1.1 2.0 2.1"),
    ("cpal", "attribution", r"common public attribution licen[cs]e", "1.0"),
    ("cpl", "common", r"common public licen[cs]e", "0.5 1.0"),
    ("ecl", "educational", r"educational community licen[cs]e", "1.0 2.0"),
    ("epl", "eclipse", r"eclipse public licen[cs]e", "1.0 2.0"),
    ("eupl", "union", r"european union public licen[cs]e", "1.0 1.1 1.2"),
    ("gfdl", "documentation", r"gnu free documentation licen[cs]e", "1.1 1.2 1.3"),
    ("gpl", "general", r"(?:gnu )?general public licen[cs]e", "1.0 2.0 3.0"),
    ("hpnd", "permission", r"historical permission notice and disclaimer", ""),
    ("ipl", "ibm", r"ibm public licen[cs]e", "1.0"),
    ("isc", "isc", r"isc licen[cs]e", ""),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e", "2.1 3.0"),
    ("lgpl-library", "library", r"(?:gnu )?library general public licen[cs]e", "2.0"),
    ("lppl", "latex", r"latex project public licen[cs]e", "1.0 1.1 1.2 1.3"),
    ("mit", "mit|expat", r"(?:the )?(?:mit|expat)(?:/x11|/expat)? licen[cs]e", ""),
    ("mit-0", "attribution", r"mit no attribution(?: licen[cs]e)?", ""),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", "1.0 1.1 2.0"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e", ""),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", ""),
    ("ncsa", "illinois", r"university of illinois/ncsa open source licen[cs]e", ""),
    ("npl", "netscape", r"netscape public licen[cs]e", "1.0 1.1"),
    ("odbl", "database", r"open database licen[cs]e", "1.0"),
    ("ofl", "font", r"(?:sil )?open font licen[cs]e", "1.0 1.1"),
    ("openssl", "openssl", r"openssl licen[cs]e", ""),
    ("osl", "open", r"open software licen[cs]e", "1.0 1.1 2.0 2.1 3.0"),
    ("php", "php", r"php licen[cs]e", "3.0 3.01"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", ""),
    ("psf", "python", r"python software foundation licen[cs]e", "2.0"),
    ("qpl", "public", r"\bq public licen[cs]e", "1.0"),
    ("ruby", "ruby", r"ruby licen[cs]e", ""),
    ("sleepycat", "sleepycat", r"sleepycat licen[cs]e", ""),
    ("sspl", "server", r"server side public licen[cs]e", "1.0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense\b", ""),
    ("upl", "universal", r"universal permissive licen[cs]e", "1.0"),
    ("vim", "vim", r"vim licen[cs]e", ""),
    ("w3c", "w3c", r"w3c software(?: notice and)? licen[cs]e", ""),
    ("wtfpl", "public", r"do what the [a-z*]+ you want to public licen[cs]e", "1.0 2.0"),
    ("x11", "x11", r"x11 licen[cs]e", ""),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[cs]e", ""),
    ("zpl", "zope", r"zope public licen[cs]e", "1.1 2.0 2.1"),
)

#: Label, the words that must occur, a clause of the license's own text.
CLAUSES = (
    ("apache", "unless applicable", r"unless required by applicable law or agreed to in writing, software distributed under the license"),
    ("bsd", "redistribution binary", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd-3-clause", "neither endorse", r"neither the name of .{1,120}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising acknowledgement", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("isc", "copy modify distribute", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee"),
    ("mit", "permission obtaining", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit", "provided warranty", r"the software is provided [\"']?as is[\"']?, without warranty of any kind"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:dedicated to|released into|placed in) the public domain"),
    ("proprietary", "proprietary confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("copyright", "copyright", r"copyright (?:\(c\)|\xc2\xa9|&copy;)? ?[0-9]{4}"),
)


#: Label, the words that must occur, a short name as people write it; no letter or digit stands beside it.
SHORT_NAMES = (
    ("agpl-3.0", "agpl|agplv3|agpl3", r"agpl(?:v|[- ]v|[- ])?3(?:\.0)?"),
    ("apache-1.1", "apache", r"apache[- ]1\.1"),
    ("apache-2.0", "apache|apache2", r"apache(?:[- ]2\.0|[- ]?2|[- ]v2(?:\.0)?)"),
    ("apache-2.0", "asl", r"asl[- ]2(?:\.0)?"),
    ("artistic-2.0", "artistic", r"artistic[- ]2\.0"),
    ("boost-1.0", "bsl", r"bsl[- ]1\.0"),
    ("bsd-0-clause", "0bsd", r"0bsd"),
    ("bsd-2-clause", "bsd", r"bsd[- ]2[- ]clause"),
    ("bsd-2-clause", "bsd", r"2[- ]clause[- ]bsd"),
    ("bsd-3-clause", "bsd", r"bsd[- ]3[- ]clause"),
    ("bsd-3-clause", "bsd", r"3[- ]clause[- ]bsd"),
    ("bsd-4-clause", "bsd", r"bsd[- ]4[- ]clause"),
    ("cc-by-2.0", "by", r"cc[- ]by[- ]2\.0"),
    ("cc-by-3.0", "by", r"cc[- ]by[- ]3\.0"),
    ("cc-by-4.0", "by", r"cc[- ]by[- ]4\.0"),
    ("cc-by-nc", "nc", r"cc[- ]by[- ]nc"),
    ("cc-by-nc-4.0", "nc", r"cc[- ]by[- ]nc[- ]4\.0"),
    ("cc-by-nc-nd", "nd", r"cc[- ]by[- ]nc[- ]nd"),
    ("cc-by-nc-nd-4.0", "nd", r"cc[- ]by[- ]nc[- ]nd[- ]4\.0"),
    ("cc-by-nc-sa", "sa", r"cc[- ]by[- ]nc[- ]sa"),
    ("cc-by-nc-sa-4.0", "sa", r"cc[- ]by[- ]nc[- ]sa[- ]4\.0"),
    ("cc-by-nd", "nd", r"cc[- ]by[- ]nd"),
    ("cc-by-nd-4.0", "nd", r"cc[- ]by[- ]nd[- ]4\.0"),
    ("cc-by-sa", "sa", r"cc[- ]by[- ]sa"),
    ("cc-by-sa-3.0", "sa", r"cc[- ]by[- ]sa[- ]3\.0"),
    ("cc-by-sa-4.0", "sa", r"cc[- ]by[- ]sa[- ]4\.0"),
    ("cddl-1.0", "cddl", r"cddl[- ]1\.0"),
    ("epl-1.0", "epl", r"epl[- ]1\.0"),
    ("epl-2.0", "epl", r"epl[- ]2\.0"),
    ("eupl-1.2", "eupl", r"eupl[- ]1\.2"),
    ("gfdl-1.3", "gfdl", r"gfdl[- ]1\.3"),
    ("gpl-2.0", "gpl|gplv2|gpl2", r"gpl(?:v|[- ]v|[- ])?2(?:\.0)?"),
    ("gpl-3.0", "gpl|gplv3|gpl3", r"gpl(?:v|[- ]v|[- ])?3(?:\.0)?"),
    ("lgpl-2.1", "lgpl|lgplv2|lgpl2", r"lgpl(?:v|[- ]v|[- ])?2\.1"),
    ("lgpl-3.0", "lgpl|lgplv3|lgpl3", r"lgpl(?:v|[- ]v|[- ])?3(?:\.0)?"),
    ("lppl-1.3", "lppl", r"lppl[- ]1\.3"),
    ("mit", "mit", r"mit[- ]licensed"),
    ("mpl-1.1", "mpl", r"mpl[- ]1\.1"),
    ("mpl-2.0", "mpl|mplv2|mpl2", r"mpl(?:v|[- ]v|[- ])?2(?:\.0)?"),
    ("ms-pl", "pl", r"ms-pl"),
    ("odbl-1.0", "odbl", r"odbl[- ]1\.0"),
    ("ofl-1.1", "ofl", r"ofl[- ]1\.1"),
    ("osl-3.0", "osl", r"osl[- ]3\.0"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("zpl-2.1", "zpl", r"zpl[- ]2\.1"),
)

#: Label, the words that must occur, an address that stands for the license, or the name of a file that holds it.
ADDRESSES = (
    ("agpl-3.0", "agpl", r"gnu\.org/licenses/agpl(?:-3\.0)?"),
    ("apache-2.0", "apache", r"apache\.org/licenses/license-2\.0"),
    ("apache-2.0", "opensource", r"opensource\.org/licenses?/apache-2\.0"),
    ("boost-1.0", "boost", r"boost\.org/license_1_0\.txt"),
    ("bsd-2-clause", "opensource", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", "opensource", r"opensource\.org/licenses?/bsd-3-clause"),
    ("cc-by-3.0", "creativecommons", r"creativecommons\.org/licenses/by/3\.0"),
    ("cc-by-4.0", "creativecommons", r"creativecommons\.org/licenses/by/4\.0"),
    ("cc-by-nc-4.0", "creativecommons", r"creativecommons\.org/licenses/by-nc/4\.0"),
    ("cc-by-nc-nd-4.0", "creativecommons", r"creativecommons\.org/licenses/by-nc-nd/4\.0"),
    ("cc-by-nc-sa-4.0", "creativecommons", r"creativecommons\.org/licenses/by-nc-sa/4\.0"),
    ("cc-by-nd-4.0", "creativecommons", r"creativecommons\.org/licenses/by-nd/4\.0"),
    ("cc-by-sa-3.0", "creativecommons", r"creativecommons\.org/licenses/by-sa/3\.0"),
    ("cc-by-sa-4.0", "creativecommons", r"creativecommons\.org/licenses/by-sa/4\.0"),
    ("cc0-1.0", "creativecommons", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("epl-2.0", "eclipse", r"eclipse\.org/legal/epl-(?:2\.0|v20)"),
    ("gfdl", "fdl", r"gnu\.org/licenses/fdl"),
    ("gpl", "gnu", r"gnu\.org/licenses/gpl"),
    ("gpl-2.0", "gnu", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", "gnu", r"gnu\.org/licenses/gpl-3\.0"),
    ("isc", "opensource", r"opensource\.org/licenses?/isc"),
    ("lgpl-2.1", "gnu", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", "gnu", r"gnu\.org/licenses/lgpl-3\.0"),
    ("mit", "opensource", r"opensource\.org/licenses?/mit(?:-license)?"),
    ("mpl-2.0", "mozilla", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("unlicense", "unlicense", r"unlicense\.org"),
    ("wtfpl", "wtfpl", r"wtfpl\.net"),
    ("apache", "license", r"license[-.]apache"),
    ("bsd", "license", r"license[-.]bsd"),
    ("gpl", "license", r"license[-.]gpl"),
    ("lgpl", "lesser", r"copying\.lesser"),
    ("mit", "license", r"license[-.]mit"),
)


@dataclass(frozen=True)
class Rule:
    """``priority`` orders the resolution; ``words`` gate the regex, of ``a|b`` one is enough; ``label`` is what it says."""

    priority: int
    label: str
    words: tuple[str, ...]
    pattern: str
    confidence: float


def rules() -> list[Rule]:
    """Every family in each of its versions as a tag, a member of a tag's expression, a grant and a name; then addresses, short names and clauses."""
    out = []
    for label, word, name, versions in FAMILIES:
        for version in [*versions.split(), ""]:
            full = f"{label}-{version}" if version else label
            number = version.removesuffix(".0")
            tail = r",? ?\(?(?:version |v\.? ?)?" + re.escape(number) + (r"(?:\.0)?" if number != version else "") + r"(?![.]?[0-9])" if version else ""
            rank = 1 if version else 0
            out.append(Rule(80 + rank, full, ("spdx",), rf"spdx-license-identifier: ?{re.escape(full)}(?:-only|-or-later)?(?![.0-9a-z-])", 0.99))
            out.append(Rule(70 + rank, full, ("spdx",), rf"(?:: ?\(|\b(?:or|and) \(?){re.escape(full)}(?:-only|-or-later)?(?![.0-9a-z-])", 0.97))
            out.append(Rule(60 + rank, full, (word,), rf"(?:licensed|released|distributed|available|redistribute it)[^.]{{0,60}}? under (?:the )?(?:terms of )?(?:the )?{name}{tail}", 0.95))
            out.append(Rule(40 + rank, full, (word,), name + tail, 0.8))
    alone = r"(?<![a-z0-9])(?:{})(?![a-z0-9]|[.][0-9])"
    out += [Rule(55, label, tuple(words.split()), alone.format(pattern), 0.9) for label, words, pattern in ADDRESSES]
    out += [Rule(45, label, tuple(words.split()), alone.format(pattern), 0.8) for label, words, pattern in SHORT_NAMES]
    out += [Rule(50, label, tuple(words.split()), pattern, 0.9) for label, words, pattern in CLAUSES[:-1]]
    out += [Rule(10, label, tuple(words.split()), pattern, 0.3) for label, words, pattern in CLAUSES[-1:]]
    return out


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    rule: Rule


def resolve(found: list[Detection]) -> list[Detection]:
    """Suppresses detections that lie inside accepted ones; equal spans keep the first label by name."""
    accepted: list[Detection] = []
    for priority in sorted({d.rule.priority for d in found}, reverse=True):
        own = sorted((d for d in found if d.rule.priority == priority), key=lambda d: (d.start, -d.end, d.rule.label))
        starts = np.array([d.start for d in accepted], np.int64)
        order = np.argsort(starts, kind="stable")
        reach = np.maximum.accumulate(np.array([d.end for d in accepted], np.int64)[order]) if accepted else starts
        furthest = -1
        fresh = []
        for d in own:
            before = int(np.searchsorted(starts[order], d.start, "right"))
            if d.end > furthest and not (before and reach[before - 1] >= d.end):
                fresh.append(d)
            furthest = max(furthest, d.end)
        accepted += fresh
    return sorted(accepted, key=lambda d: (d.start, d.end))


#: Any run of white space, with the mark of a comment where a line begins; possessive, so that it is read once.
_BLANK = r"(?:[^\S\r\n]|[\r\n]\s*+(?:(?:/?\*{1,2}|/{2,3}|\#{1,3}|;{1,3}|%{1,3}|!{1,3}|>{1,3}|--|\||dnl|rem)(?=\s))?+)++"


def _spaced(pattern: str) -> str:
    """A blank in a rule is any run of white space, over the lines of a comment too."""
    marks = {"[- ]": rf"(?:-|{_BLANK})", " ?": rf"(?:{_BLANK})?+", " ": _BLANK}
    return re.sub(r"\[- \]| \??", lambda m: marks[m[0]], pattern)


@lru_cache(maxsize=1)
def _compiled() -> tuple[np.ndarray, list[tuple[Rule, tuple[frozenset[int], ...], re.Pattern[bytes]]], list[tuple[str, np.ndarray]]]:
    every = rules()
    words = sorted({w for r in every for each in r.words for w in each.split("|")})
    gates = np.array([word_hash(w) for w in words], np.uint64)
    order = np.argsort(gates)
    place = {words[i]: k for k, i in enumerate(order)}
    gated = [(r, tuple(frozenset(place[w] for w in each.split("|")) for each in r.words), re.compile(_spaced(r.pattern).encode("latin-1"), re.DOTALL)) for r in every]
    phrases = [(label, np.array([word_hash(w) for w in phrase.split()], np.uint64)) for phrase, label in BASE_PHRASES]
    return gates[order], gated, phrases


def _gates_open(tokens: Tokens, gates: np.ndarray) -> dict[int, set[int]]:
    """Of each text with any keyword, which keywords it has."""
    at = np.minimum(np.searchsorted(gates, tokens.hashes), len(gates) - 1)
    hit = np.flatnonzero(gates[at] == tokens.hashes)
    owner = np.searchsorted(tokens.bounds, hit, "right") - 1
    out: dict[int, set[int]] = {}
    for text, gate in np.unique(np.stack([owner, at[hit]], axis=1), axis=0).tolist() if len(hit) else []:
        out.setdefault(text, set()).add(gate)
    return out


SCHEMA = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("detections", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("priority", T.IntegerType()),
        T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    ]))),
])
_ARROW = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
    pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64())])),
]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gates, gated, phrases = _compiled()
    for part in chunks(batches):
        tokens = tokenise(part.column("text"), ALNUM)
        base: dict[int, list[tuple[int, str]]] = {}
        for label, phrase in phrases:
            n = len(tokens.hashes) - len(phrase) + 1
            if n <= 0:
                continue
            same = np.logical_and.reduce([tokens.hashes[k : k + n] == w for k, w in enumerate(phrase)])
            at = np.flatnonzero(same)
            owner = np.searchsorted(tokens.bounds, at, "right") - 1
            inside = at + len(phrase) <= tokens.bounds[owner + 1]
            for text, place in zip(owner[inside].tolist(), (at - tokens.bounds[owner])[inside].tolist()):
                base.setdefault(text, []).append((place, label))
        opened = _gates_open(tokens, gates)
        edges = raw_bytes(part.column("text"))[1]
        rows = []
        for text in range(part.num_rows):
            places = base.get(text, [])
            labels = {label for _, label in places}
            confidence, detections = 0.5 if places else 0.0, []
            if have := opened.get(text):
                body = LOWER[tokens.data[edges[text] : edges[text + 1]]].tobytes()
                found = [Detection(m.start(), m.end(), rule) for rule, need, regex in gated if not any(have.isdisjoint(each) for each in need) for m in regex.finditer(body)]
                own = tokens.starts[tokens.bounds[text] : tokens.bounds[text + 1]] - edges[text]
                for d in resolve(found):
                    first, last = (int(np.searchsorted(own, x)) for x in (d.start, d.end))
                    detections.append({"label": d.rule.label, "priority": d.rule.priority, "first_word": first, "last_word": max(first, last - 1)})
                    confidence = max(confidence, d.rule.confidence)
            every = labels | {d["label"] for d in detections}
            rows.append((
                int(tokens.bounds[text + 1] - tokens.bounds[text]), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
                ",".join(sorted(labels)), ",".join(sorted(every)), confidence, detections,
            ))
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), _ARROW)]
        yield pa.RecordBatch.from_arrays([part.column("_kept"), *columns], ["_kept", *SCHEMA.names])


def scan_licenses(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """License findings of every row, beside its ``keep`` columns.

    Null and empty texts have no words, no labels and the score 0.  Texts are
    scanned whole, each row on its own, without a shuffle; repeated rows get
    repeated results.  Empty label lists are empty strings.
    """
    rows = docs.select(F.col(text).alias("text"), F.struct(*(F.col(c) for c in keep)).alias("_kept"))
    schema = T.StructType([rows.schema["_kept"], *SCHEMA.fields])
    return rows.mapInArrow(_scan, schema).select("_kept.*", *SCHEMA.names)
