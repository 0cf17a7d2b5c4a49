"""License detection by an ordered list of signatures.

A text is brought to words between single spaces. A signature's keyword tells whether
it is tried at all, and its regular expression where it stands. A detection that lies inside one of
a higher priority, or inside a longer one of the same, is suppressed; base phrases
are counted apart and are never suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortloom.llm.common import plain_words, text_columns

#: Priorities: a bare name, a notice, a name with version, the text of a grant.
NAME, NOTICE, VERSION, GRANT = 1, 2, 3, 4
#: What one detection of a priority says that the document is licensed.
WEIGHT = {NAME: 0.3, NOTICE: 0.5, VERSION: 0.8, GRANT: 0.95}

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Rule:
    """``pattern`` is met between spaces in text of plain words; ``keyword`` stands in each match."""

    label: str
    keyword: str
    pattern: str
    priority: int


def version(number: str) -> str:
    """A version as words: 3.0 is written 3 0, v3 0, version 3 0, and 3.0 also 3."""
    major, _, minor = number.partition(".")
    tail = f" {minor}" if minor not in ("", "0") else "(?: 0)?"
    return f"(?:v|v |ver |version )?{major}{tail}"


def family(label: str, keyword: str, name: str, versions: str, *, bare: bool = True,
           key: str = "") -> list[Rule]:
    """Signatures of a license with versions: name and version, and the name alone."""
    rules = [Rule(f"{label}-{v}", keyword, f"(?:{name})(?: license)? {version(v)}", VERSION)
             for v in versions.split()]
    if bare:
        rules.append(Rule(key or label, keyword, name, NAME))
    return rules


# Hand-written signatures. In patterns words stand between single spaces.
def creative_commons() -> list[Rule]:
    parts = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial",
             "nd": "no ?deriv(?:ative|ative work|ative works|atives|s)"}
    rules = []
    for code in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        label = "cc-" + code.replace(" ", "-")
        words = " ".join(parts[p] for p in code.split())
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            major, minor = v.split(".")
            rules += [
                Rule(f"{label}-{v}", f"cc {code}", f"cc {code} {major} {minor}", VERSION),
                Rule(f"{label}-{v}", "creative commons",
                     f"creative commons {words}(?: license)? {version(v)}", GRANT)]
        rules += [Rule(label, f"cc {code}", f"cc {code}(?! (?:sa|nc|nd|[1-4] ))", NAME),
                  Rule(label, "creative commons", f"creative commons {words}", NOTICE)]
    return [*rules,
            Rule("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?", VERSION),
            Rule("cc0-1.0", "creative commons", "creative commons(?: cc0| zero)(?: 1 0)?", GRANT),
            Rule("cc-url", "creativecommons", "creativecommons org licenses [a-z]+(?: [a-z]+)*", NOTICE),
            Rule("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0", GRANT),
            Rule("cc-pd", "creativecommons", "creativecommons org publicdomain mark 1 0", GRANT),
            Rule("cc", "creative commons", "creative commons(?: license)?", NAME)]


def gnu() -> list[Rule]:
    rules = []
    for label, short, kind, versions in (
            ("gpl", "gpl", "general", "1.0 2.0 3.0"),
            ("lgpl", "lgpl", "(?:lesser|library) general", "2.0 2.1 3.0"),
            ("agpl", "agpl", "affero general", "1.0 3.0")):
        name = f"(?:gnu )?{kind} public license"
        for v in versions.split():
            later = f"{version(v)}(?: of the license)?(?: or at your option any later version| or later| or any later version)"
            rules += [
                Rule(f"{label}-{v}", "public license", f"{name} {version(v)}", VERSION),
                Rule(f"{label}-{v}-or-later", "public license", f"{name} {later}", GRANT),
                Rule(f"{label}-{v}", short, f"(?:gnu )?{short} ?{version(v)}(?: only)?", VERSION),
                Rule(f"{label}-{v}-or-later", short,
                     f"(?:gnu )?{short} ?{version(v)}(?: or later| or newer| plus)", GRANT)]
        rules += [Rule(label, "public license", name, NOTICE),
                  Rule(label, short, f"(?:gnu )?{short}", NAME)]
    for v in ("1.1", "1.2", "1.3"):
        rules += [Rule(f"gfdl-{v}", "documentation license",
                       f"gnu free documentation license {version(v)}", VERSION),
                  Rule(f"gfdl-{v}", "gfdl", f"gfdl {version(v)}", VERSION)]
    return [*rules,
            Rule("gfdl", "documentation license", "gnu free documentation license", NOTICE),
            Rule("gpl-exception", "exception", "classpath exception", NOTICE),
            Rule("gpl-grant", "redistribute it",
                 "you can redistribute it and or modify it under the terms of the gnu(?: [a-z]+){1,3} license",
                 GRANT),
            Rule("gpl-grant", "free software foundation",
                 "as published by the free software foundation", NOTICE)]


def permissive() -> list[Rule]:
    def one(label, keyword, pattern, priority=NOTICE):
        return Rule(label, keyword, pattern, priority)

    bsd = []
    for n, word in (("2", "two"), ("3", "three"), ("4", "four")):
        bsd += [one(f"bsd-{n}-clause", "clause bsd", f"(?:{n}|{word}) clause bsd(?: license)?", VERSION),
                one(f"bsd-{n}-clause", "bsd", f"bsd {n} clause(?: license)?", VERSION)]
    return [
        *family("apache", "apache", "apache(?: software)? license|apache", "1.0 1.1 2.0", bare=False),
        one("apache", "apache license", "apache license"),
        one("apache-2.0", "apache org", "(?:www )?apache org licenses license 2 0", GRANT),
        one("apache-2.0", "apache license",
            "licensed under the apache license(?: version)? 2 0", GRANT),
        one("mit", "mit license", "mit license"), one("mit", "mit", "mit licensed"),
        one("mit", "mit license", "(?:released|licensed|distributed|available) under the(?: terms of the)? mit license", GRANT),
        one("mit-grant", "permission is hereby",
            "permission is hereby granted free of charge to any person obtaining a copy", GRANT),
        one("mit-0", "mit no attribution", "mit no attribution(?: license)?", VERSION),
        one("x11", "x11 license", "(?:mit )?x11 license"), one("expat", "expat license", "expat license"),
        *bsd, one("bsd", "bsd license", "(?:new |modified |simplified |original )?bsd license"),
        one("bsd", "bsd style", "bsd style license"), one("0bsd", "0bsd", "0bsd", VERSION),
        one("0bsd", "bsd zero", "bsd zero clause(?: license)?", VERSION),
        one("bsd-grant", "redistribution and use",
            "redistribution and use in source and binary forms with or without modification(?: are permitted)?", GRANT),
        one("bsd-grant", "redistributions of source", "redistributions of source code must retain the above copyright notice"),
        one("bsd-grant", "redistributions in binary", "redistributions in binary form must reproduce the above copyright notice"),
        one("bsd-endorse", "endorse or promote", "may be used to endorse or promote products derived"),
        one("isc", "isc license", "isc license"),
        one("isc-grant", "permission to use", "permission to use copy modify and or distribute this software for any purpose", GRANT),
        one("hpnd", "permission to use", "permission to use copy modify and distribute this software and its documentation", GRANT),
        one("zlib", "zlib", "zlib(?: libpng)? license"),
        one("zlib-grant", "provided as is", "this software is provided as is without any express or implied warranty"),
        one("unlicense", "unlicense", "(?:the )?unlicense"), one("unlicense", "unlicense org", "unlicense org", VERSION),
        one("unlicense-grant", "unencumbered", "free and unencumbered software released into the public domain", GRANT),
        one("wtfpl", "wtfpl", "wtfpl"), one("wtfpl", "do what the", "do what the fuck you want to public license", GRANT),
        one("bsl-1.0", "boost software", "boost software license(?: version)?(?: 1 0)?", VERSION),
        one("postgresql", "postgresql", "postgresql license"), one("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? license"),
        *family("python", "python software", "python software foundation license", "2.0"),
        *family("python", "psf license", "psf license", "2.0"),
        *family("php", "php license", "php license", "3.0 3.01"), one("ruby", "ruby license", "ruby license"),
        one("vim", "vim license", "vim license"), one("w3c", "w3c", "w3c software(?: and document)?(?: notice and)? license"),
        one("curl", "curl license", "curl license"), one("openssl", "openssl", "openssl license"),
        one("libpng", "libpng", "libpng license"), one("libtiff", "libtiff", "libtiff license"),
        one("icu", "icu license", "icu license"), one("unicode", "unicode", "unicode(?: terms of use| license| data files)"),
        one("beerware", "beerware", "beerware(?: license)?"),
        one("json", "good not evil", "shall be used for good not evil", GRANT),
        one("tcl", "tcl", "tcl(?: tk)? license"), one("upl-1.0", "universal permissive", "universal permissive license(?: 1 0)?", VERSION),
        one("blueoak-1.0", "blue oak", "blue oak model license(?: 1 0 0)?", VERSION),
        one("mulan", "mulan", "mulan(?: psl| permissive)(?: software)?(?: license)?"),
        *family("afl", "academic free", "academic free license", "1.1 1.2 2.0 2.1 3.0"),
        *family("artistic", "artistic license", "artistic license", "1.0 2.0"),
        *family("ecl", "educational community", "educational community license", "1.0 2.0"),
        *family("ms-pl", "microsoft public", "microsoft public license", "1.0"), one("ms-pl", "ms pl", "ms pl"),
        *family("zpl", "zope public", "zope public license", "1.1 2.0 2.1"),
    ]


def copyleft() -> list[Rule]:
    return [
        *family("mpl", "mozilla public", "mozilla public license", "1.0 1.1 2.0"),
        *family("mpl", "mpl", "mpl", "1.0 1.1 2.0", bare=False),
        *family("epl", "eclipse public", "eclipse public license", "1.0 2.0"),
        *family("epl", "epl", "epl", "1.0 2.0", bare=False),
        *family("edl", "eclipse distribution", "eclipse distribution license", "1.0"),
        *family("cddl", "common development", "common development and distribution license", "1.0 1.1"),
        *family("cddl", "cddl", "cddl", "1.0 1.1"),
        *family("cpl", "common public", "common public license", "0.5 1.0"),
        *family("ipl", "ibm public", "ibm public license", "1.0"),
        *family("eupl", "european union public", "european union public licen[cs]e", "1.0 1.1 1.2"),
        *family("eupl", "eupl", "eupl", "1.0 1.1 1.2"),
        *family("cecill", "cecill", "cecill(?: [abc])?", "1.0 1.1 2.0 2.1"),
        *family("osl", "open software license", "open software license", "1.0 1.1 2.0 2.1 3.0"),
        *family("rpl", "reciprocal public", "reciprocal public license", "1.1 1.5"),
        *family("ms-rl", "microsoft reciprocal", "microsoft reciprocal license", "1.0"),
        *family("apsl", "apple public", "apple public source license", "1.0 1.1 1.2 2.0"),
        *family("qpl", "q public", "q public license", "1.0"),
        *family("sissl", "industry standards", "sun industry standards source license", "1.1 1.2"),
        *family("spl", "sun public", "sun public license", "1.0"),
        *family("npl", "netscape public", "netscape public license", "1.0 1.1"),
        *family("lppl", "latex project", "latex project public license", "1.0 1.1 1.2 1.3"),
        *family("cpal", "common public attribution", "common public attribution license", "1.0"),
        *family("nosa", "nasa open", "nasa open source agreement", "1.3"),
        *family("sleepycat", "sleepycat", "sleepycat license", "1.0"),
        *family("erlpl", "erlang public", "erlang public license", "1.1"),
    ]


def data_and_models() -> list[Rule]:
    return [
        *family("ofl", "open font", "(?:sil )?open font license", "1.0 1.1"),
        *family("odbl", "open database", "open database license", "1.0"), *family("odbl", "odbl", "odbl", "1.0"),
        *family("odc-by", "open data commons", "open data commons attribution license", "1.0"),
        *family("pddl", "public domain dedication", "public domain dedication and license", "1.0"),
        *family("ogl", "open government", "open government licen[cs]e", "1.0 2.0 3.0"),
        *family("cdla", "community data", "community data license agreement", "1.0 2.0"),
        *family("openrail", "openrail", "(?:bigscience |creativeml )?openrail(?: m)?", "1.0"),
        *family("llama", "llama", "llama [23] (?:[0-9] )?community license(?: agreement)?", "2.0 3.0"),
        *family("free-art", "free art", "free art license", "1.2 1.3"),
        *family("opl", "open publication", "open publication license", "1.0"),
        *family("sspl", "server side public", "server side public license", "1.0"), *family("sspl", "sspl", "sspl", "1.0"),
        *family("busl", "business source", "business source license", "1.0 1.1"),
        *family("elastic", "elastic license", "elastic license", "1.0 2.0"),
        *family("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict)(?: license)?", "1.0"),
        *family("confluent", "confluent community", "confluent community license", "1.0"),
        *family("timescale", "timescale license", "timescale license", "1.0"),
        Rule("commons-clause", "commons clause", "commons clause(?: license condition)?", NOTICE),
        Rule("gemma", "gemma terms", "gemma terms of use", NOTICE),
    ]


def notices() -> list[Rule]:
    def one(label, keyword, pattern):
        return Rule(label, keyword, pattern, NOTICE)

    return [
        one("reserved-notice", "all rights reserved", "copyright(?: c)?(?: [0-9]{4})?(?: [^ ]+){0,6} all rights reserved"),
        one("copyright", "copyright", "copyright(?: c)? [0-9]{4}"), one("copyright", "copyrighted", "copyrighted (?:material|work)"),
        one("rights-some", "some rights", "some rights reserved"), one("rights-none", "no rights", "no rights reserved"),
        one("proprietary", "proprietary", "proprietary and confidential|confidential and proprietary"),
        one("proprietary", "trade secret", "trade secrets? of"),
        one("no-reproduction", "may be reproduced", "no part of this (?:[a-z]+ )?may be reproduced"),
        one("no-reproduction", "written permission", "without (?:the )?(?:prior |express )*written permission"),
        one("no-reproduction", "without permission", "without permission of the (?:author|publisher|owner)"),
        one("no-redistribution", "redistribut", "(?:may|must|shall) not be redistributed|redistribution is (?:not permitted|prohibited)"),
        one("public-domain", "public domain", "(?:released |dedicated |placed )?(?:in|into|to) the public domain"),
        one("personal-use", "personal use", "(?:for )?personal use only"),
        one("non-commercial", "commercial use", "(?:non ?commercial use only|not for commercial use)"),
        one("research-only", "research", "(?:for )?(?:academic |non commercial )?research (?:use|purposes) only"),
        one("fair-use", "fair use", "fair use (?:notice|policy|doctrine)"),
        one("spdx", "spdx license", "spdx license identifier [^ ]+(?: [^ ]+){0,3}"),
        one("see-license", "license file", "see (?:the )?(?:accompanying )?license file"),
        one("dual", "dual licen", "dual licen[cs]ed under"),
        one("royalty-free", "royalty free", "(?:perpetual |worldwide |non exclusive |no charge )*royalty free(?: irrevocable)? (?:copyright )?license"),
        one("eula", "end user license", "end user license agreement"), one("terms", "terms of use", "subject to (?:the|our) terms of use"),
        one("no-warranty", "warrant", "without warrant(?:y|ies)(?: or conditions)? of any kind"),
        one("no-warranty", "absolutely no warranty", "comes with absolutely no warranty"),
        one("no-liability", "be liable", "in no event shall(?: [^ ]+){1,8} be liable"),
    ]


def all_rules() -> list[Rule]:
    """The signatures, highest priority first."""
    rules = [*creative_commons(), *gnu(), *permissive(), *copyleft(), *data_and_models(), *notices()]
    return sorted(dict.fromkeys(rules), key=lambda r: -r.priority)


Span = tuple[int, int, str, int]


class LicenseScanner:
    """Compiled signatures by the keyword that gates them."""

    def __init__(self, rules: list[Rule] | None = None):
        self.rules = all_rules() if rules is None else rules
        compiled: dict[bytes, list] = {}
        for rule in self.rules:
            pattern = re.compile(f"(?<= )(?:{rule.pattern})(?= )".encode())
            compiled.setdefault(rule.keyword.encode(), []).append((pattern, rule))
        self.by_keyword = compiled
        self.base = [(re.compile(f"(?<= ){p}(?= )".encode()), p.encode(), label)
                     for p, label in BASE.items()]

    def base_places(self, text: bytes) -> list[tuple[int, str]]:
        """(word, label) of each place of a base phrase."""
        return sorted((text.count(b" ", 0, m.start()) - 1, label)
                      for pattern, phrase, label in self.base if phrase in text
                      for m in pattern.finditer(text))

    def detections(self, text: bytes) -> list[Span]:
        """(first word, end word, label, priority) of all matches, suppressed ones too."""
        out = []
        for keyword, own in self.by_keyword.items():
            if keyword in text:
                for pattern, rule in own:
                    for m in pattern.finditer(text):
                        first = text.count(b" ", 0, m.start()) - 1
                        out.append((first, first + 1 + m.group().count(b" "), rule.label,
                                    rule.priority))
        return out


def resolve(found: list[Span]) -> list[Span]:
    """The detections that lie in no other of higher priority, nor in a longer one of their own.

    Of equal places and priorities the label first in order stays. One pass over
    each priority, so that many detections in a text cost no more than sorting.
    """
    kept: list[Span] = []
    for priority in sorted({d[3] for d in found}, reverse=True):
        kept.sort()
        starts = [d[0] for d in kept]
        reach = list(accumulate((d[1] for d in kept), max))
        last, new = -1, []
        for d in sorted((d for d in found if d[3] == priority), key=lambda d: (d[0], -d[1], d[2])):
            at = bisect_right(starts, d[0])
            if d[1] > last and not (at and reach[at - 1] >= d[1]):
                new.append(d)
                last = d[1]
        kept += new
    return sorted(kept)


def score(kept: list[Span], base: list[tuple[int, str]]) -> float:
    """1 less the product of what each distinct label leaves open; a base label is a notice."""
    weight = {label: WEIGHT[NOTICE] for _, label in base}
    for _, _, label, priority in kept:
        weight[label] = max(weight.get(label, 0.0), WEIGHT[priority])
    left = 1.0
    for w in sorted(weight.values()):
        left *= 1.0 - w
    return round(1.0 - left, 6)


def scan_licenses(docs: DataFrame, *, ident: str = "doc_id", text: str = "text",
                  rules: list[Rule] | None = None) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    Words are counted from 0; detections are the kept ones as (label, start, end).
    A null or empty text has no words and nothing is found. Repeated rows are scanned
    each; an empty table gives no rows; other columns are not read, whatever their
    names. A very long text is scanned whole by one task. One pass over the texts, no
    shuffle.
    """
    frame = docs.select(docs[ident].alias("ident"), docs[text].alias("_text"))

    def prepare():
        scanner = LicenseScanner(rules)

        def scan(texts):
            rows = []
            for words in map(plain_words, texts):
                whole = b" " + b" ".join(words) + b" "
                base = scanner.base_places(whole)
                kept = resolve(scanner.detections(whole))
                own = {label for _, label in base}
                places = [p for p, _ in base]
                rows.append((
                    len(words), len(base), places[0] if places else None,
                    places[-1] if places else None, ",".join(sorted(own)),
                    ",".join(sorted(own | {d[2] for d in kept})), score(kept, base),
                    [{"label": d[2], "start": d[0], "end": d[1]} for d in kept]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                [("label", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))]
            return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return scan

    long, string = T.LongType(), T.StringType()
    detection = T.StructType([T.StructField("label", string), T.StructField("start", T.IntegerType()),
                              T.StructField("end", T.IntegerType())])
    fields = [T.StructField("n_words", long), T.StructField("n_base", long),
              T.StructField("first_word", long), T.StructField("last_word", long),
              T.StructField("base_labels", string), T.StructField("labels", string),
              T.StructField("score", T.DoubleType()),
              T.StructField("detections", T.ArrayType(detection))]
    return text_columns(frame, "_text", fields, prepare, ["ident"]).withColumnRenamed("ident", ident)
