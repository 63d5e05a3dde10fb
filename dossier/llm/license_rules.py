"""Signature rules for licenses: ordered regular expressions on the words of a text.

A pattern is matched against lower-cased words with single spaces between them
(``CC BY-NC 4.0`` reads ``cc by nc 4 0``). One word, between ``<`` and ``>``, or one
of several words separated by ``|``, is its keyword: a pattern is tried only where
its keyword stands. A pattern repeats no spaces, so that it spans a bounded number
of words.
"""

import re
from typing import NamedTuple

# How sure a rule is, best first: a machine-readable tag, a grant or address, a bare name, a hint.
TAG, NOTICE, NAME, HINT = range(4)

# More words than any rule has on either side of its keyword.
SPAN = 20

_L = "licen[sc]e"
_GRANTED = "(?:licensed|released|distributed|available|provided|published|offered|covered)"
_UNDER = f"{_GRANTED} under (?:the )?(?:terms of )?(?:the )?"


class Rule(NamedTuple):
    label: str
    priority: int
    pattern: str
    base: bool = False

    @property
    def keywords(self) -> list[str]:
        return re.search("<(.+?)>", self.pattern)[1].split("|")

    def regex(self, keyword: str, mark: str = "\x01") -> str:
        """The expression for one keyword, which ``mark`` precedes in the text; a space precedes the first word."""
        return " " + re.sub("<.+?>", mark + keyword, self.pattern) + "(?= |$)"


# Fixed values of the contract: phrases and their labels.
BASE = [
    Rule("mit", NOTICE, "under the mit <license>", True),
    Rule("apache-2", NOTICE, "<apache> license version 2", True),
    Rule("cc-by-nc", NOTICE, "<cc> by nc", True),
]


def _v(number: str) -> str:
    """A version in words: ``version 2 0``, ``v2``, ``2 0``."""
    major, _, minor = number.partition(" ")
    return f"(?:version |v ?)?{major}" + (f" {minor}" if minor and minor != "0" else "(?: 0)?")


def _gnu(short: str, kind: str, version: str) -> list[str]:
    late = "(?: only| or later| or any later version)?"
    return [
        f"<gnu> {kind}public {_L} {_v(version)}{late}",
        f"<{short}> (?:{_L} )?{_v(version)}{late}",
        f"<{short}v{version[0]}>(?: {version[2:]})?" if len(version) > 1 else f"<{short}v{version}>(?: 0)?",
    ]


def _cc(parts: str, spoken: str) -> list[str]:
    version = "(?: [1-4] 0)?(?: international| unported| generic)?"
    return [f"<cc> {parts}{version}", f"<creative> commons {spoken}{version}(?: public)?(?: {_L})?"]


# By label: how the license is named, its identifier in tags, and addresses of its text.
NAMES: dict[str, list[str]] = {
    "mit": [f"mit <{'license|licence'}>", f"<expat> {_L}", f"<x11> {_L}"],
    "mit-0": [f"<mit> no attribution(?: {_L})?", "<mit> 0"],
    "apache-2": [f"<apache> (?:software )?(?:foundation )?{_L} {_v('2 0')}", "<apache> 2 0", "<asl> 2 0", "<apache2>"],
    "apache-1.1": [f"<apache> (?:software )?{_L} {_v('1 1')}", "<apache> 1 1"],
    "bsd-2-clause": [f"<bsd> 2 clause(?: {_L})?", f"(?:simplified|2 clause|two clause|freebsd) <bsd>(?: {_L})?", f"<freebsd> {_L}"],
    "bsd-3-clause": [f"<bsd> 3 clause(?: {_L})?", f"(?:new|modified|revised|3 clause|three clause) <bsd>(?: {_L})?"],
    "bsd-4-clause": [f"<bsd> 4 clause(?: {_L})?", f"(?:original|old|4 clause|four clause) <bsd>(?: {_L})?"],
    "bsd-0-clause": [f"<0bsd>(?: {_L})?", f"(?:zero clause|0 clause) <bsd>(?: {_L})?"],
    "bsd": [f"<bsd> (?:style )?{_L}"],
    "isc": [f"<isc> {_L}"],
    "zlib": [f"<zlib> (?:libpng )?{_L}", f"<libpng> {_L}"],
    "boost-1": [f"<boost> software {_L}(?: {_v('1 0')})?", "<bsl> 1 0"],
    "unlicense": ["the <unlicense>", "<unlicense>"],
    "wtfpl": ["<wtfpl>", f"do what the <fuck> you want to public {_L}"],
    "gpl-1": _gnu("gpl", "general ", "1"),
    "gpl-2": _gnu("gpl", "general ", "2"),
    "gpl-3": _gnu("gpl", "general ", "3"),
    "lgpl-2": _gnu("lgpl", "library general ", "2"),
    "lgpl-2.1": _gnu("lgpl", "lesser general ", "2 1"),
    "lgpl-3": _gnu("lgpl", "lesser general ", "3"),
    "agpl-3": _gnu("agpl", "affero general ", "3"),
    "gfdl-1.1": [f"<gnu> free documentation {_L} {_v('1 1')}", "<gfdl> 1 1"],
    "gfdl-1.2": [f"<gnu> free documentation {_L} {_v('1 2')}", "<gfdl> 1 2"],
    "gfdl-1.3": [f"<gnu> free documentation {_L} {_v('1 3')}", "<gfdl> 1 3"],
    "gpl": [f"<gnu> general public {_L}", f"<gpl>(?: {_L})?"],
    "lgpl": [f"<gnu> (?:lesser|library) general public {_L}", f"<lgpl>(?: {_L})?"],
    "agpl": [f"<gnu> affero general public {_L}", f"<agpl>(?: {_L})?"],
    "gfdl": [f"<gnu> free documentation {_L}", "<gfdl>"],
    "mpl-1.1": [f"<mozilla> public {_L} {_v('1 1')}", "<mpl> (?:v ?)?1 1"],
    "mpl-2": [f"<mozilla> public {_L} {_v('2 0')}", "<mpl> (?:v ?)?2(?: 0)?"],
    "mpl": [f"<mozilla> public {_L}"],
    "epl-1": [f"<eclipse> public {_L} {_v('1 0')}", "<epl> (?:v ?)?1(?: 0)?"],
    "epl-2": [f"<eclipse> public {_L} {_v('2 0')}", "<epl> (?:v ?)?2(?: 0)?"],
    "edl-1": [f"<eclipse> distribution {_L}(?: {_v('1 0')})?"],
    "eupl-1.1": [f"<european> union public {_L} {_v('1 1')}", "<eupl> (?:v ?)?1 1"],
    "eupl-1.2": [f"<european> union public {_L} {_v('1 2')}", "<eupl> (?:v ?)?1 2"],
    "cddl-1": [f"<cddl>(?: {_v('1 0')})?", f"common <development> and distribution {_L}(?: {_v('1 0')})?"],
    "cpl-1": [f"<common> public {_L}(?: {_v('1 0')})?"],
    "ipl-1": [f"<ibm> public {_L}(?: {_v('1 0')})?"],
    "apsl-2": [f"<apple> public source {_L}(?: {_v('2 0')})?"],
    "ms-pl": [f"<microsoft> public {_L}", "<ms> pl"],
    "ms-rl": [f"<microsoft> reciprocal {_L}", "<ms> rl"],
    "osl-3": [f"<osl> {_v('3 0')}", f"open software {_L} <{'v3|3'}>(?: 0)?"],
    "afl-3": [f"<academic> free {_L}(?: {_v('3 0')})?", f"<afl> {_v('3 0')}"],
    "artistic-1": [f"<artistic> {_L} {_v('1 0')}", "<artistic> 1 0"],
    "artistic-2": [f"<artistic> {_L} {_v('2 0')}", "<artistic> 2 0"],
    "artistic": [f"<artistic> {_L}"],
    "psf-2": [f"<psf> {_L}(?: agreement)?", f"<python> software foundation {_L}(?: {_v('2 0')})?"],
    "python-2": [f"<python> {_L} {_v('2 0')}"],
    "php-3": [f"<php> {_L}(?: {_v('3 0')})?", "<php> 3 0(?:1)?"],
    "ruby": [f"<ruby> {_L}"],
    "ncsa": [f"<ncsa>(?: open source)? {_L}", f"university of <illinois> ncsa open source {_L}"],
    "postgresql": [f"<postgresql> {_L}"],
    "openssl": [f"<openssl> {_L}"],
    "curl": [f"<curl> {_L}"],
    "w3c": [f"<w3c> (?:software )?(?:notice and )?{_L}"],
    "unicode": [f"<unicode> (?:data files and software )?{_L}"],
    "ofl-1.1": [f"<sil> open font {_L}(?: {_v('1 1')})?", "<ofl> 1 1", f"open <font> {_L}"],
    "ecl-2": [f"<educational> community {_L}(?: {_v('2 0')})?"],
    "lppl-1.3": [f"<latex> project public {_L}(?: {_v('1 3')}c?)?", "<lppl> 1 3c?"],
    "qpl-1": [f"q <public> {_L}", "<qpl> 1 0"],
    "sleepycat": [f"<sleepycat> {_L}"],
    "vim": [f"<vim> {_L}"],
    "beerware": ["<beerware>(?: license)?", f"<beer> ware {_L}"],
    "upl-1": [f"<universal> permissive {_L}(?: {_v('1 0')})?", "<upl> 1 0"],
    "bsl-1.1": [f"<business> source {_L}(?: {_v('1 1')})?"],
    "sspl-1": [f"<server> side public {_L}(?: {_v('1')})?", "<sspl>(?: v1| 1 0)?"],
    "elastic-2": [f"<elastic> {_L}(?: {_v('2 0')})?"],
    "polyform-nc-1": [f"<polyform> noncommercial(?: {_L})?(?: 1 0 0)?"],
    "odbl-1": ["<odbl>(?: 1 0)?", f"open <database> {_L}(?: {_v('1 0')})?"],
    "odc-by-1": ["<odc> by(?: 1 0)?", f"open data <commons> attribution {_L}(?: {_v('1 0')})?"],
    "pddl-1": ["<pddl>(?: 1 0)?", "public domain <dedication> and license"],
    "ogl-3": [f"open <government> {_L}(?: {_v('3 0')})?"],
    "cc0-1": ["<cc0>(?: 1 0)?", "<creative> commons zero(?: (?:v ?)?1 0)?(?: universal)?", "<cc> zero(?: 1 0)?"],
    "cc-by": _cc("by", "attribution"),
    "cc-by-sa": _cc("by sa", "attribution share ?alike"),
    "cc-by-nd": _cc("by nd", "attribution no ?deriv(?:ative)?s?"),
    "cc-by-nc": _cc("by nc", "attribution non ?commercial"),
    "cc-by-nc-sa": _cc("by nc sa", "attribution non ?commercial share ?alike"),
    "cc-by-nc-nd": _cc("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?"),
    "openrail": ["<openrail>(?: m)?", "<bigscience> rail(?: license)?"],
    "llama": [f"<llama> [234] community {_L}(?: agreement)?"],
}

# Identifiers in machine-readable tags, in words.
TAGS: dict[str, str] = {
    "mit": "mit", "mit-0": "<mit> 0", "apache-2": "<apache> 2 0", "apache-1.1": "<apache> 1 1", "isc": "<isc>", "zlib": "<zlib>",
    "bsd-2-clause": "<bsd> 2 clause", "bsd-3-clause": "<bsd> 3 clause", "bsd-4-clause": "<bsd> 4 clause", "bsd-0-clause": "<0bsd>",
    "boost-1": "<bsl> 1 0", "unlicense": "<unlicense>", "wtfpl": "<wtfpl>", "ncsa": "<ncsa>", "postgresql": "<postgresql>",
    "gpl-1": "<gpl> 1 0(?: only| or later)?", "gpl-2": "<gpl> 2 0(?: only| or later)?", "gpl-3": "<gpl> 3 0(?: only| or later)?",
    "lgpl-2": "<lgpl> 2 0(?: only| or later)?", "lgpl-2.1": "<lgpl> 2 1(?: only| or later)?",
    "lgpl-3": "<lgpl> 3 0(?: only| or later)?", "agpl-3": "<agpl> 3 0(?: only| or later)?",
    "gfdl-1.2": "<gfdl> 1 2(?: only| or later)?", "gfdl-1.3": "<gfdl> 1 3(?: only| or later)?",
    "mpl-1.1": "<mpl> 1 1", "mpl-2": "<mpl> 2 0", "epl-1": "<epl> 1 0", "epl-2": "<epl> 2 0", "eupl-1.2": "<eupl> 1 2",
    "cddl-1": "<cddl> 1 0", "ms-pl": "<ms> pl", "ms-rl": "<ms> rl", "osl-3": "<osl> 3 0", "afl-3": "<afl> 3 0",
    "artistic-2": "<artistic> 2 0", "psf-2": "<psf> 2 0", "ofl-1.1": "<ofl> 1 1", "lppl-1.3": "<lppl> 1 3c", "upl-1": "<upl> 1 0",
    "bsl-1.1": "<busl> 1 1", "sspl-1": "<sspl> 1 0", "odbl-1": "<odbl> 1 0", "odc-by-1": "<odc> by 1 0", "pddl-1": "<pddl> 1 0",
    "cc0-1": "<cc0> 1 0", "cc-by": "<cc> by [1-4] 0", "cc-by-sa": "<cc> by sa [1-4] 0", "cc-by-nd": "<cc> by nd [1-4] 0",
    "cc-by-nc": "<cc> by nc [1-4] 0", "cc-by-nc-sa": "<cc> by nc sa [1-4] 0", "cc-by-nc-nd": "<cc> by nc nd [1-4] 0",
}

# Grants, addresses and sentences of the license texts themselves.
NOTICES: list[tuple[str, str]] = [
    ("mit", "permission is <hereby> granted free of charge to any person obtaining a copy"),
    ("mit", "<opensource> org licenses mit(?: license)?"),
    ("mit", "<mit> licensed"),
    ("apache-2", "<apache> org licenses license 2 0"),
    ("apache-2", "<opensource> org licenses apache 2 0"),
    ("apache-2", "<apache> 2 0 licensed"),
    ("bsd", "<redistribution> and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "<opensource> org licenses bsd 3 clause"),
    ("bsd-2-clause", "<opensource> org licenses bsd 2 clause"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is <hereby> granted"),
    ("zlib", "this software is provided as is without any express or implied <warranty>"),
    ("unlicense", "this is free and unencumbered software released into the public <domain>"),
    ("unlicense", "<unlicense> org"),
    ("public-domain", "(?:released|placed|dedicated|contributed) (?:in|into|to) the public <domain>"),
    ("gpl", "free software you can <redistribute> it and or modify it under the terms of the gnu general public license"),
    ("gpl", "<gnu> org licenses gpl"),
    ("gpl-2", "<gnu> org licenses old licenses gpl 2 0"),
    ("gpl-3", "<gnu> org licenses gpl 3 0"),
    ("lgpl", "<gnu> org licenses lgpl"),
    ("agpl", "<gnu> org licenses agpl"),
    ("mpl-2", "<mozilla> org mpl 2 0"),
    ("mpl-2", "this source code form is subject to the terms of the <mozilla> public license v 2 0"),
    ("epl-2", "<eclipse> org legal epl 2 0"),
    ("wtfpl", "you just do what the <fuck> you want to"),
    ("beerware", "you can buy me a <beer> in return"),
    ("cc0-1", "<creativecommons> org publicdomain zero 1 0"),
    ("cc-by", "<creativecommons> org licenses by [1-4] 0"),
    ("cc-by-sa", "<creativecommons> org licenses by sa [1-4] 0"),
    ("cc-by-nd", "<creativecommons> org licenses by nd [1-4] 0"),
    ("cc-by-nc", "<creativecommons> org licenses by nc [1-4] 0"),
    ("cc-by-nc-sa", "<creativecommons> org licenses by nc sa [1-4] 0"),
    ("cc-by-nc-nd", "<creativecommons> org licenses by nc nd [1-4] 0"),
    ("odbl-1", "<opendatacommons> org licenses odbl"),
    ("ofl-1.1", "<scripts> sil org ofl"),
    ("proprietary", "all <rights> reserved"),
    ("proprietary", "<proprietary> and confidential"),
    ("proprietary", "unauthorized <copying> of this file"),
    ("proprietary", "may not be reproduced without (?:prior )?written <permission>"),
]

# A license is spoken of, but which one is not understood.
HINTS: list[str] = [
    "<licensed> under",
    "subject to the <terms> of (?:the|this) license",
    "see (?:the )?(?:file )?<license> (?:file |txt |md )?for (?:more )?details",
    "terms and conditions of (?:the|this) <license>",
    "end user <license> agreement",
    "creative <commons> license",
]


def license_rules() -> list[Rule]:
    """All rules in order: of rules of one priority, the earlier wins at the same place."""
    rules = list(BASE)
    for label, tag in TAGS.items():
        spelt = tag if "<" in tag else f"<license> identifier {tag}"
        rules.append(Rule(label, TAG, f"spdx license identifier {tag}" if "<" in tag else f"spdx {spelt}"))
    for label, names in NAMES.items():
        rules += [Rule(label, NOTICE, _UNDER + name) for name in names]
    rules += [Rule(label, NOTICE, pattern) for label, pattern in NOTICES]
    for label, names in NAMES.items():
        rules += [Rule(label, NAME, name) for name in names]
    rules += [Rule("unknown", HINT, pattern) for pattern in HINTS]
    for rule in rules:
        left, right = re.split("<.+?>", rule.pattern)
        if max(left.count(" "), right.count(" ")) > SPAN or re.search(r"[*+]| \{", rule.pattern):
            raise ValueError(f"a rule must span at most {SPAN} words on either side of its keyword: {rule.pattern}")
    return rules
