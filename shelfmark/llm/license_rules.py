"""Signature rules for licenses: what to look for, how sure it is, what it yields to.

A rule is a regular expression over a text whose words are in lower case and separated
by one blank. Rules are ordered: by rank (0 first), then by their place here.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Phrases whose every place counts, with their labels.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# label: what every match holds, then the ways the license is named; a way that does
# not hold it has its own, in a pair
NAMES = {
    "mit": ("mit", "mit(?: x11)? licen[sc]e", "the mit licen[sc]e", ("expat", "expat licen[sc]e")),
    "apache-2": ("apache", "apache(?: software)? licen[sc]e(?: version)? 2(?: 0)?", "apache 2(?: 0)?(?: licen[sc]e)?"),
    "apache-1.1": ("apache", "apache(?: software)? licen[sc]e(?: version)? 1 1"),
    "apache": ("apache", "apache(?: software)? licen[sc]e"),
    "bsd-2": ("bsd", "bsd 2 clause(?: licen[sc]e)?", "2 clause bsd(?: licen[sc]e)?", "simplified bsd licen[sc]e", "freebsd licen[sc]e"),
    "bsd-3": ("bsd", "bsd 3 clause(?: licen[sc]e)?", "3 clause bsd(?: licen[sc]e)?", "(?:new|modified|revised) bsd licen[sc]e"),
    "bsd-4": ("bsd", "bsd 4 clause(?: licen[sc]e)?", "original bsd licen[sc]e"),
    "bsd-0": ("0bsd", "0bsd(?: licen[sc]e)?"),
    "bsd": ("bsd", "bsd(?: style)? licen[sc]e"),
    "isc": ("isc", "isc licen[sc]e"),
    "zlib": ("zlib", "zlib(?: libpng)? licen[sc]e"),
    "gpl-2": ("general", "gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: gpl)?(?: version)? v?2(?: 0)?"),
    "gpl-3": ("general", "gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: gpl)?(?: version)? v?3(?: 0)?"),
    "gpl": ("general", "gnu general public licen[sc]e"),
    "gpl-2-short": ("gpl", "gpl ?v?2(?: 0)?(?: only| or later)?", "gplv2(?: 0)?"),
    "gpl-3-short": ("gpl", "gpl ?v?3(?: 0)?(?: only| or later)?", "gplv3(?: 0)?"),
    "lgpl-2.1": ("lesser", "gnu lesser general public licen[sc]e(?: version)? v?2 1", ("lgpl", "lgpl ?v?2 1")),
    "lgpl-3": ("lesser", "gnu lesser general public licen[sc]e(?: version)? v?3(?: 0)?"),
    "lgpl": ("general", "gnu (?:lesser|library) general public licen[sc]e"),
    "lgpl-short": ("lgpl", "lgpl(?: v?[23](?: [01])?)?"),
    "agpl-3": ("affero", "gnu affero general public licen[sc]e(?: version)?(?: v?3(?: 0)?)?"),
    "agpl-short": ("agpl", "agpl ?v?3?(?: 0)?"),
    "mpl-2": ("mozilla", "mozilla public licen[sc]e(?: version)? v?2(?: 0)?", ("mpl", "mpl ?v?2(?: 0)?")),
    "mpl-1.1": ("mozilla", "mozilla public licen[sc]e(?: version)? v?1 1"),
    "mpl": ("mozilla", "mozilla public licen[sc]e"),
    "epl-2": ("eclipse", "eclipse public licen[sc]e(?: version)? v?2(?: 0)?"),
    "epl-1": ("eclipse", "eclipse public licen[sc]e(?: version)? v?1(?: 0)?"),
    "cddl": ("distribution", "common development and distribution licen[sc]e(?: version)?(?: v?1 [01])?"),
    "cpl": ("common", "common public licen[sc]e(?: version)?(?: v?1 0)?"),
    "eupl": ("european", "european union public licen[sc]e(?: version)?(?: v?1 [0-2])?"),
    "artistic-2": ("artistic", "artistic licen[sc]e(?: version)? v?2(?: 0)?"),
    "artistic": ("artistic", "artistic licen[sc]e"),
    "boost": ("boost", "boost software licen[sc]e(?: version)?(?: 1 0)?"),
    "python": ("python", "python software foundation licen[sc]e(?: version)?(?: 2)?", ("psf", "psf licen[sc]e")),
    "postgresql": ("postgresql", "postgresql licen[sc]e"),
    "openssl": ("openssl", "openssl licen[sc]e"),
    "php": ("php", "php licen[sc]e(?: version)?(?: 3 0[01]?)?"),
    "ms-pl": ("microsoft", "microsoft public licen[sc]e", ("ms pl", "ms pl")),
    "ms-rl": ("microsoft", "microsoft reciprocal licen[sc]e", ("ms rl", "ms rl")),
    "ofl": ("font", "(?:sil )?open font licen[sc]e(?: version)?(?: 1 [01])?"),
    "wtfpl": ("wtfpl", "wtfpl(?: version)?(?: 2)?"),
    "unlicense": ("unlicense", "(?:the )?unlicense"),
    "beerware": ("beerware", "beerware(?: licen[sc]e)?"),
    "odbl": ("database", "open (?:data commons )?database licen[sc]e(?: odbl)?(?: v?1 0)?"),
    "odc-by": ("commons", "open data commons attribution licen[sc]e(?: v?1 0)?"),
    "pddl": ("dedication", "(?:open data commons )?public domain dedication and licen[sc]e"),
    "gfdl": ("documentation", "gnu free documentation licen[sc]e(?: version)?(?: 1 [1-3])?"),
    "cc0": ("cc0", "cc0(?: 1 0)?(?: universal)?"),
    "cc-by": ("attribution", "creative commons attribution(?: licen[sc]e)?(?: (?:[1-4] 0|2 5))?(?: international| unported)?"),
    "cc-by-sa": ("attribution", "creative commons attribution share ?alike(?: licen[sc]e)?(?: [1-4] 0)?", "creative commons attribution sharealike"),
    "cc-by-nd": ("attribution", "creative commons attribution no ?deriv(?:s|atives)(?: licen[sc]e)?(?: [1-4] 0)?"),
    "cc-by-nc": ("attribution", "creative commons attribution non ?commercial(?: licen[sc]e)?(?: [1-4] 0)?"),
    "cc-by-nc-sa": ("attribution", "creative commons attribution non ?commercial share ?alike(?: licen[sc]e)?(?: [1-4] 0)?"),
    "cc-by-nc-nd": ("attribution", "creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: licen[sc]e)?(?: [1-4] 0)?"),
    "cc-by-short": ("cc", "cc by(?: [1-4] 0)?"),
    "cc-by-sa-short": ("cc", "cc by sa(?: [1-4] 0)?"),
    "cc-by-nd-short": ("cc", "cc by nd(?: [1-4] 0)?"),
    "cc-by-nc-short": ("cc", "cc by nc(?: [1-4] 0)?"),
    "cc-by-nc-sa-short": ("cc", "cc by nc sa(?: [1-4] 0)?"),
    "cc-by-nc-nd-short": ("cc", "cc by nc nd(?: [1-4] 0)?"),
}

# how a named license is put to use: rank, score, text around the name
FORMS = [
    (1, 1.0, "spdx licen[sc]e identifier {}"),
    (1, 0.95, "(?:licen[sc]ed|released|distributed|published|available|provided|issued|shared|covered)"
              "(?: to you)? (?:under|by)(?: the)?(?: terms(?: and conditions)? of)?(?: the| an?)? {}"),
    (2, 0.9, "(?:licen[sc]e|licen[sc]ed|licen[sc]ing) {}"),
    (2, 0.85, "(?:under|subject to)(?: the)?(?: terms of)?(?: the| an?)? {}"),
    (3, 0.8, "{}"),
]

# label, score, the word that must be in the text, expression
NOTICES = [
    ("cc0", 0.9, "zero", "creative commons zero"),
    ("cc-by", 0.9, "creativecommons", "creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", 0.9, "creativecommons", "creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nd", 0.9, "creativecommons", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc", 0.9, "creativecommons", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc-sa", 0.9, "creativecommons", "creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", 0.9, "creativecommons", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc0", 0.9, "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("apache-2", 0.9, "apache", "apache org licenses license 2 0"),
    ("mit", 0.9, "opensource", "opensource org licenses mit"),
    ("bsd-3", 0.9, "opensource", "opensource org licenses bsd 3 clause"),
    ("gpl", 0.8, "gnu", "gnu org licenses gpl(?: [23] 0)?"),
    ("lgpl", 0.8, "gnu", "gnu org licenses lgpl(?: [23] [01])?"),
    ("mit", 0.9, "charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 0.9, "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", 0.8, "redistribution", "redistribution and use in source and binary forms with or without modification"),
    ("public-domain", 0.8, "domain", "(?:released|placed|dedicated) (?:in ?to|to|in) the public domain"),
    ("public-domain", 0.6, "domain", "public domain"),
    ("proprietary", 0.7, "reserved", "all rights reserved"),
    ("proprietary", 0.7, "proprietary", "proprietary and confidential"),
    ("proprietary", 0.6, "permission", "(?:may|must) not be (?:copied|reproduced|redistributed|distributed) without(?: \\S+){0,3} permission"),
    ("warranty-disclaimer", 0.3, "warranty", "without (?:any )?warranty of any kind"),
    ("warranty-disclaimer", 0.3, "warranties", "without warranties or conditions of any kind"),
    ("warranty-disclaimer", 0.3, "warranty", "provided as is without (?:any )?(?:express or implied )?warranty"),
    ("copyright-notice", 0.3, "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}"),
]


@dataclass(frozen=True)
class Rule:
    id: int
    rank: int
    score: float
    label: str
    keyword: str
    pattern: str


def rules() -> list[Rule]:
    """All rules: base phrases, every name in every form, then notices."""
    out: list[tuple] = [(0, 1.0, label, phrase.split()[0], phrase) for phrase, label in BASE]
    for rank, score, form in FORMS:
        for label, (keyword, *names) in NAMES.items():
            for name in names:
                held, name = name if isinstance(name, tuple) else (keyword, name)
                out.append((rank, score, label.removesuffix("-short"), held, form.format(f"(?:{name})")))
    out += [(3, score, label, keyword, pattern) for label, score, keyword, pattern in NOTICES]
    return [
        # looking around keeps the blank for the next match
        Rule(i, rank, score, label, keyword, f"(?<= ){pattern}(?= )")
        for i, (rank, score, label, keyword, pattern) in enumerate(out)
    ]
