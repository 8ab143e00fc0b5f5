"""License scans (operator 3).

Texts are normalised to lower-case words joined by single spaces.  An ordered
list of signature rules, each a regex over normalised text with a mandatory
keyword, runs over every text that holds the keyword.  Rules come from four
hand-written parts: full-text clauses of licenses, names of licenses under
which they are mentioned, the notice forms a name appears in, and the
identifiers that SPDX tags and their expressions (AND, OR, WITH) hold.

Detections that overlap are resolved in order of (priority, length, place):
one that lies inside a detection of equal or higher priority is suppressed.
Base phrases are always reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm._util import map_texts

#: Fixed phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Names of licenses as regexes over normalised words: (label, keyword, regex).
NAMES = (
    ("apache-2.0", "apache", r"apache (?:software )?(?:license )?(?:version |v ?)?2(?: 0)?"),
    ("apache-1.1", "apache", r"apache (?:software )?(?:license )?(?:version |v ?)?1 1"),
    ("apache-1.0", "apache", r"apache (?:software )?(?:license )?(?:version |v ?)?1 0"),
    ("apache", "apache", r"apache (?:software )?license"),
    ("mit", "mit", r"mit license"),
    ("mit-0", "mit", r"mit (?:no attribution|0)(?: license)?"),
    ("x11", "x11", r"x11 license"),
    ("bsd-0-clause", "bsd", r"(?:zero clause bsd|0bsd|bsd 0 clause)(?: license)?"),
    ("bsd-1-clause", "bsd", r"(?:1 clause bsd|bsd 1 clause)(?: license)?"),
    ("bsd-2-clause", "bsd", r"(?:(?:2|two) clause bsd|simplified bsd|freebsd|bsd 2 clause)(?: license)?"),
    ("bsd-3-clause", "bsd", r"(?:(?:3|three) clause bsd|new bsd|modified bsd|revised bsd|bsd 3 clause)(?: license)?"),
    ("bsd-4-clause", "bsd", r"(?:(?:4|four) clause bsd|original bsd|old bsd|bsd 4 clause)(?: license)?"),
    ("bsd", "bsd", r"bsd (?:style )?license"),
    ("gpl-1.0", "general public license", r"(?:gnu )?general public license (?:version |v ?)1(?: 0)?"),
    ("gpl-2.0", "general public license", r"(?:gnu )?general public license (?:version |v ?)2(?: 0)?"),
    ("gpl-3.0", "general public license", r"(?:gnu )?general public license (?:version |v ?)3(?: 0)?"),
    ("gpl-1.0", "gpl", r"gpl ?(?:version |v ?)?1(?: 0)?"),
    ("gpl-2.0", "gpl", r"gpl ?(?:version |v ?)?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"gpl ?(?:version |v ?)?3(?: 0)?"),
    ("lgpl-2.0", "library general public license", r"(?:gnu )?library general public license"),
    ("lgpl-2.1", "lesser general public license", r"(?:gnu )?lesser general public license (?:version |v ?)2(?: 1)?"),
    ("lgpl-3.0", "lesser general public license", r"(?:gnu )?lesser general public license (?:version |v ?)3(?: 0)?"),
    ("lgpl", "lesser general public license", r"(?:gnu )?lesser general public license"),
    ("lgpl-2.1", "lgpl", r"lgpl ?(?:version |v ?)?2(?: 1)?"),
    ("lgpl-3.0", "lgpl", r"lgpl ?(?:version |v ?)?3(?: 0)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: (?:version |v ?)3(?: 0)?)?"),
    ("agpl-3.0", "agpl", r"agpl ?(?:version |v ?)?3(?: 0)?"),
    ("gfdl-1.1", "free documentation license", r"(?:gnu )?free documentation license (?:version |v ?)?1 1"),
    ("gfdl-1.2", "free documentation license", r"(?:gnu )?free documentation license (?:version |v ?)?1 2"),
    ("gfdl-1.3", "free documentation license", r"(?:gnu )?free documentation license (?:version |v ?)?1 3"),
    ("gfdl", "free documentation license", r"(?:gnu )?free documentation license"),
    ("mpl-1.0", "mozilla public license", r"mozilla public license (?:version |v ?)?1 0"),
    ("mpl-1.1", "mozilla public license", r"mozilla public license (?:version |v ?)?1 1"),
    ("mpl-2.0", "mozilla public license", r"mozilla public license (?:version |v ?)?2(?: 0)?"),
    ("mpl", "mozilla public license", r"mozilla public license"),
    ("mpl-2.0", "mpl", r"mpl ?2(?: 0)?"),
    ("epl-1.0", "eclipse public license", r"eclipse public license (?:version |v ?)?1(?: 0)?"),
    ("epl-2.0", "eclipse public license", r"eclipse public license (?:version |v ?)?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse (?:public|distribution) license"),
    ("cddl-1.0", "common development and distribution", r"common development and distribution license(?: (?:version |v ?)?1 0)?"),
    ("cddl-1.1", "common development and distribution", r"common development and distribution license (?:version |v ?)?1 1"),
    ("cpl-1.0", "common public license", r"common public license(?: (?:version |v ?)?1 0)?"),
    ("ipl-1.0", "ibm public license", r"ibm public license"),
    ("eupl-1.1", "european union public", r"european union public licence (?:version |v ?)?1 1"),
    ("eupl-1.2", "european union public", r"european union public licence (?:version |v ?)?1 2"),
    ("eupl", "european union public", r"european union public licen[cs]e"),
    ("artistic-1.0", "artistic", r"artistic license (?:version |v ?)?1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic license (?:version |v ?)?2(?: 0)?"),
    ("artistic", "artistic", r"artistic license"),
    ("perl", "perl", r"same terms as perl(?: itself)?"),
    ("python-2.0", "python", r"python (?:software foundation )?license(?: (?:version |v ?)?2(?: 0)?)?"),
    ("php-3.01", "php", r"php license(?: (?:version |v ?)?3 01)?"),
    ("ruby", "ruby", r"ruby license"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("libpng", "libpng", r"libpng license"),
    ("openssl", "openssl", r"openssl license"),
    ("ssleay", "ssleay", r"(?:original )?ssleay license"),
    ("curl", "curl", r"curl license"),
    ("isc", "isc", r"isc license"),
    ("boost-1.0", "boost", r"boost software license(?: (?:version |v ?)?1 0)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "what the", r"do what the fuck you want to public license"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("beerware", "beer", r"beer ?ware license"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("ofl-1.1", "open font license", r"(?:sil )?open font license(?: (?:version |v ?)?1 1)?"),
    ("odbl-1.0", "open database license", r"open database license(?: (?:version |v ?)?1 0)?"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution license"),
    ("pddl-1.0", "public domain dedication", r"(?:odc )?public domain dedication and licen[cs]e"),
    ("osl-3.0", "open software license", r"open software license(?: (?:version |v ?)?3(?: 0)?)?"),
    ("afl-3.0", "academic free license", r"academic free license(?: (?:version |v ?)?3(?: 0)?)?"),
    ("ms-pl", "microsoft public license", r"microsoft public license"),
    ("ms-rl", "microsoft reciprocal license", r"microsoft reciprocal license"),
    ("sspl-1.0", "server side public license", r"server side public license(?: (?:version |v ?)?1)?"),
    ("bsl-1.1", "business source license", r"business source license(?: (?:version |v ?)?1 1)?"),
    ("elastic-2.0", "elastic", r"elastic license(?: (?:version |v ?)?2(?: 0)?)?"),
    ("commons-clause", "commons clause", r"commons clause(?: license condition)?"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license"),
    ("w3c", "w3c", r"w3c software (?:notice and )?license"),
    ("upl-1.0", "universal permissive license", r"universal permissive license(?: (?:version |v ?)?1(?: 0)?)?"),
    ("vim", "vim", r"vim license"),
    ("json", "json", r"json license"),
    ("icu", "icu", r"icu license"),
    ("unicode", "unicode", r"unicode (?:inc )?license agreement"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-4.0", "cc by", r"cc by 4(?: 0)?"),
    ("cc-by-3.0", "cc by", r"cc by 3(?: 0)?"),
    ("cc-by-2.5", "cc by", r"cc by 2 5"),
    ("cc-by-2.0", "cc by", r"cc by 2 0"),
    ("cc-by-sa-4.0", "cc by sa", r"cc by sa 4(?: 0)?"),
    ("cc-by-sa-3.0", "cc by sa", r"cc by sa 3(?: 0)?"),
    ("cc-by-sa", "cc by sa", r"cc by sa"),
    ("cc-by-nc-4.0", "cc by nc", r"cc by nc 4(?: 0)?"),
    ("cc-by-nc", "cc by nc", r"cc by nc"),
    ("cc-by-nd", "cc by nd", r"cc by nd(?: [1-4](?: [05])?)?"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa(?: [1-4](?: [05])?)?"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd(?: [1-4](?: [05])?)?"),
    ("cc-by", "creative commons", r"creative commons attribution(?: [1-4](?: [05])?)?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike(?: [1-4](?: [05])?)?"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial(?: [1-4](?: [05])?)?"),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative)?s(?: [1-4](?: [05])?)?"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|in to|into|to) the public domain"),
)

#: Notice forms around a name: (kind, words before the name, priority).
FORMS = (
    ("grant", r"(?:is |are )?(?:licensed|released|distributed|available|provided|published|issued) "
              r"under (?:the )?(?:terms of )?(?:the )?(?:gnu )?", 30),
    ("name", "", 50),
)

#: Identifiers of SPDX tags.  The label is the identifier, or stands behind "=".
SPDX = """
    MIT MIT-0 MIT-CMU MIT-Modern-Variant ISC X11 Zlib zlib-acknowledgement Libpng libpng-2.0=libpng
    NCSA W3C W3C-20150513=w3c curl ICU Unicode-3.0=unicode Unicode-DFS-2015=unicode
    Unicode-DFS-2016=unicode Unicode-TOU=unicode JSON Vim Ruby Beerware WTFPL Unlicense PostgreSQL
    OpenSSL SSLeay-standalone=ssleay NTP HPND Intel Info-ZIP IJG FTL BlueOak-1.0.0 Fair Naumen
    0BSD=bsd-0-clause BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-2-Clause-Views BSD-3-Clause
    BSD-3-Clause-Clear BSD-3-Clause-LBNL BSD-3-Clause-Attribution BSD-4-Clause BSD-4-Clause-UC
    BSD-Source-Code BSL-1.0=boost-1.0 BUSL-1.1=bsl-1.1
    Apache-1.0 Apache-1.1 Apache-2.0 AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 APSL-1.0 APSL-2.0
    Artistic-1.0 Artistic-1.0-cl8=artistic-1.0 Artistic-1.0-Perl=artistic-1.0 Artistic-2.0
    CDDL-1.0 CDDL-1.1 CPL-1.0 CPAL-1.0 CPOL-1.02 CECILL-1.0 CECILL-1.1 CECILL-2.0 CECILL-2.1 CECILL-B
    CECILL-C EPL-1.0 EPL-2.0 EUPL-1.0 EUPL-1.1 EUPL-1.2 ECL-1.0 ECL-2.0 EFL-1.0 EFL-2.0 IPL-1.0
    Elastic-2.0 SSPL-1.0 UPL-1.0 MulanPSL-1.0 MulanPSL-2.0 MPL-1.0 MPL-1.1 MPL-2.0
    MPL-2.0-no-copyleft-exception=mpl-2.0 MS-PL MS-RL MS-LPL NPL-1.0 NPL-1.1 NPOSL-3.0 OSL-1.0
    OSL-1.1 OSL-2.0 OSL-2.1 OSL-3.0 OFL-1.0 OFL-1.0-RFN=ofl-1.0 OFL-1.0-no-RFN=ofl-1.0 OFL-1.1
    OFL-1.1-RFN=ofl-1.1 OFL-1.1-no-RFN=ofl-1.1 OLDAP-2.8 PHP-3.0 PHP-3.01 PSF-2.0=python-2.0
    Python-2.0 Python-2.0.1 QPL-1.0 RPL-1.5 SISSL Sleepycat SPL-1.0 TCL TU-Berlin-2.0 LPPL-1.0
    LPPL-1.1 LPPL-1.2 LPPL-1.3a LPPL-1.3c ZPL-1.1 ZPL-2.0 ZPL-2.1 xpp Xnet
    GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0 AGPL-1.0 AGPL-3.0 GFDL-1.1 GFDL-1.2 GFDL-1.3
    ODbL-1.0 ODC-By-1.0 PDDL-1.0 CC0-1.0 CC-PDDC CDLA-Permissive-1.0 CDLA-Permissive-2.0
    CDLA-Sharing-1.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-1.0 CC-BY-SA-2.0
    CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-1.0 CC-BY-NC-2.0 CC-BY-NC-2.5 CC-BY-NC-3.0
    CC-BY-NC-4.0 CC-BY-ND-1.0 CC-BY-ND-2.0 CC-BY-ND-2.5 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-NC-SA-1.0
    CC-BY-NC-SA-2.0 CC-BY-NC-SA-2.5 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-1.0 CC-BY-NC-ND-2.0
    CC-BY-NC-ND-2.5 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0
    Autoconf-exception-2.0 Autoconf-exception-3.0 Bison-exception-2.2 Bootloader-exception
    Classpath-exception-2.0 eCos-exception-2.0 Font-exception-2.0 GCC-exception-2.0
    GCC-exception-3.1 GPL-CC-1.0 Libtool-exception Linux-syscall-note LLVM-exception
    LGPL-3.0-linking-exception OCaml-LGPL-linking-exception OpenJDK-assembly-exception-1.0
    Qt-LGPL-exception-1.1 Qt-GPL-exception-1.0 Swift-exception Universal-FOSS-exception-1.0
    WxWindows-exception-3.1
"""
#: Licenses whose identifiers end in -only or -or-later.
_LATER = ("gpl", "lgpl", "agpl", "gfdl")

#: Clauses that identify a license text: (label, keyword, regex).
CLAUSES = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "neither the name", r"neither the name of (?:\S+ ){1,8}nor the names of its contributors"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software"),
    ("apache-2.0", "licensed under the apache", r"licensed under the apache license version 2 0 the license"),
    ("gpl", "free software", r"this program is free software you can redistribute it and or modify"),
    ("gpl-or-later", "any later version", r"or at your option any later version"),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("boost-1.0", "boost", r"distributed under the boost software license"),
    ("mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public license"),
    ("cc0-1.0", "waived all copyright", r"waived all copyright and related or neighboring rights"),
    ("mit", "substantial portions", r"this permission notice shall be included in all copies or substantial portions of the software"),
    ("ofl-1.1", "font software", r"permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("boost-1.0", "accompanying documentation", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("bsd", "redistributions of source code", r"redistributions of source code must retain the above copyright notice"),
    ("zlib", "held liable", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("apache-2.0", "derivative works of", r"irrevocable copyright license to reproduce prepare derivative works of"),
    ("gpl-2.0", "take away your freedom", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "copyleft license", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3.0", "network server software", r"specifically designed to ensure cooperation with the community in the case of network server software"),
    ("lgpl", "this library is free software", r"this library is free software you can redistribute it and or modify"),
    ("lgpl-2.0", "library general public license", r"this license the library general public license applies to some specially designated free software foundation software"),
    ("lgpl-2.1", "lesser general public license", r"this license the lesser general public license applies to some specially designated software packages"),
    ("lgpl-3.0", "lesser general public license", r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3"),
    ("gfdl", "functional and useful document", r"make a manual textbook or other (?:functional and useful|written) document free in the sense of freedom"),
    ("mpl-1.1", "covered code", r"covered code means the original code or modifications"),
    ("mpl-2.0", "incompatible with secondary licenses", r"incompatible with secondary licenses as defined by the mozilla public license"),
    ("epl", "accompanying program", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("epl-2.0", "secondary licenses", r"may also be made available under the following secondary licenses when the conditions for such availability set forth in the eclipse public license v(?:ersion)? 2 0"),
    ("cpl-1.0", "accompanying program", r"the accompanying program is provided under the terms of this common public license"),
    ("cddl", "original software", r"first makes original software available under this license"),
    ("artistic-1.0", "artistic control", r"the copyright holder maintains some semblance of artistic control over the development of the package"),
    ("artistic-2.0", "given free software package", r"this license establishes the terms under which a given free software package may be copied"),
    ("eupl", "european union public licence", r"this european union public licence the eupl applies to the work"),
    ("cc", "creative commons public license", r"provided under the terms of this creative commons public license"),
    ("cc-by-4.0", "creative commons", r"conditions of this creative commons attribution 4 0 international public license"),
    ("cc-by-sa-4.0", "creative commons", r"conditions of this creative commons attribution sharealike 4 0 international public license"),
    ("cc-by-nc-4.0", "creative commons", r"conditions of this creative commons attribution noncommercial 4 0 international public license"),
    ("cc-by-nd-4.0", "creative commons", r"conditions of this creative commons attribution noderivatives 4 0 international public license"),
    ("cc-by-nc-sa-4.0", "creative commons", r"conditions of this creative commons attribution noncommercial sharealike 4 0 international public license"),
    ("cc-by-nc-nd-4.0", "creative commons", r"conditions of this creative commons attribution noncommercial noderivatives 4 0 international public license"),
    ("wtfpl", "you just do what", r"you just do what the fuck you want to"),
    ("warranty-disclaimer", "as is", r"provided as is without (?:any )?warranty(?: of any kind)?"),
    ("proprietary", "confidential", r"proprietary and confidential"),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|reproduction|use|distribution)(?: or \S+)? of this"),
    ("no-commercial", "commercial", r"(?:for )?non ?commercial (?:use|purposes) only"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"),
)


def _spdx() -> list[tuple[str, str]]:
    """(label, regex over normalised words) of every identifier."""
    out = []
    for entry in SPDX.split():
        name, _, label = entry.partition("=")
        label = label or name.lower()
        words = " ".join(re.findall("[a-z0-9]+", name.lower()))
        if label.split("-")[0] in _LATER and "exception" not in label and label != "gpl-cc-1.0":
            kind = "(?: no)?(?: invariants)?" if label.startswith("gfdl") else ""
            out += [(label, f"{words}{kind}(?: only)?"),
                    (f"{label}-or-later", f"{words}{kind} or later")]
        else:
            out.append((label, words))
    return out


def rules() -> list[tuple[int, str, bytes, re.Pattern]]:
    """(priority, label, keyword, regex) in order; lower priorities win.  A
    regex with a group detects the group's words."""
    out = [(0, label, phrase.encode(), re.compile(rb"(?<= )" + phrase.encode() + rb"(?= )"))
           for phrase, label in BASE]
    out += [(20, label, kw.encode(), re.compile(rf"(?<= ){rx}(?= )".encode()))
            for label, kw, rx in CLAUSES]
    tag = "spdx license identifier"
    ids = _spdx()
    # An expression's first identifier counts with the tag, the others alone.
    before = "|".join([*sorted((rx for _, rx in ids), key=len, reverse=True),
                       r"(?:documentref(?: [^ ]+){1,8}? )?licenseref(?: [^ ]+){1,8}?"])
    for label, rx in ids:
        out.append((40, label, tag.encode(),
                    re.compile(rf"(?<= ){tag} {rx}(?: license)?(?= )".encode())))
        out.append((40, label, tag.encode(), re.compile(
            rf"(?<= ){tag} (?:(?:{before}) (?:and|or|with) )+({rx})(?= )".encode())))
    out.append((40, "spdx-tag", b"spdx", re.compile(rf"(?<= ){tag}(?= )".encode())))
    for kind, lead, priority in FORMS:
        for label, kw, rx in NAMES:
            if kind == "grant" and label == "public-domain":
                continue  # its words are a grant already
            # A notice form also needs its own first word, the gate of most texts.
            out.append((priority, label, kw.encode(),
                        re.compile(rf"(?<= ){lead}{rx}(?: license)?(?= )".encode())))
    return sorted(out, key=lambda r: r[0])


@lru_cache(maxsize=1)
def _compiled():
    """Rules by keyword, and one regex that finds which keywords a text holds."""
    by: dict[bytes, list] = {}
    for r in rules():
        by.setdefault(r[2], []).append(r)
    return by


#: Everything but digits, letters and non-ASCII bytes becomes a space.
_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c
               if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def scan_text(text: bytes) -> tuple[int, list[tuple[int, int, str, int]]]:
    """(number of words, detections) of one UTF-8 text.

    A detection is (first word, last word, label, priority) after
    suppression, in order of place.  Base detections have priority 0.
    """
    words = text.translate(_WORDS).split()
    norm = b" " + b" ".join(words) + b" "
    found, base = [], []
    for keyword, rs in _compiled().items():
        if keyword not in norm:
            continue
        for priority, label, _, rx in rs:
            for m in rx.finditer(norm):
                (base if priority == 0 else found).append((priority, *m.span(rx.groups), label))
    if not found and not base:
        return len(words), []
    # Strongest first; what lies inside a kept detection of the same or a
    # higher priority is suppressed.  Kept detections never contain each
    # other, so in order of start their ends ascend too.
    found.sort(key=lambda d: (d[0], d[1] - d[2], d[1], d[3]))
    starts: list[int] = []
    ends: list[int] = []
    kept = list(base)
    for d in found:
        at = bisect_right(starts, d[1])
        if at and ends[at - 1] >= d[2]:
            continue
        kept.append(d)
        # Drop kept ones inside the new one from the index: it covers them.
        lo = bisect_left(starts, d[1])
        hi = bisect_right(ends, d[2], lo=lo)
        starts[lo:hi], ends[lo:hi] = [d[1]], [d[2]]
    kept.sort(key=lambda d: (d[1], d[2], d[0], d[3]))
    out, word, at = [], 0, 0
    for priority, s, e, label in kept:
        word += norm.count(b" ", at, s) if s > at else 0
        at = max(at, s)
        first = word - 1  # the leading space comes before word 0
        out.append((first, first + norm.count(b" ", s, e), label, priority))
    return len(words), out


_SCAN = ("doc_id long, n_words long, "
         "detections array<struct<first:long,last:long,label:string,priority:int>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, detections) per row of ``docs``, whole texts.

    Detections are ordered by place; words count from 0.  A null or empty text
    has no words and none.  Repeated rows give repeated results, a null doc_id
    stays null, other columns are not read, an empty table gives none.
    """
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()),
                               ("label", pa.string()), ("priority", pa.int32())]))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        got = [scan_text(t or b"") for t in b.column("_text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([n for n, _ in got], pa.int64()),
             pa.array([[{"first": a, "last": z, "label": label, "priority": p}
                        for a, z, label, p in d] for _, d in got], kind)],
            names=["doc_id", "n_words", "detections"])
    return map_texts(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                                 F.col(f"`{text_col}`").cast("string").cast("binary").alias("_text")),
                     run, _SCAN, "_text")


def digest(scanned: DataFrame) -> DataFrame:
    """One row per scanned document: places of base phrases, labels and a score.

    The score is the share of the text's words that detections span (a license
    file nears 1, a mention 0), 0 without detections.
    """
    base = F.filter("detections", lambda d: d["priority"] == 0)
    joined = lambda ds: F.array_join(F.array_sort(F.array_distinct(
        F.transform(ds, lambda d: d["label"]))), ",")
    # Words covered: detections in order of start, counted past the last end.
    covered = F.aggregate(
        "detections", F.struct(F.lit(-1).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, d: F.struct(
            F.greatest(acc["end"], d["last"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), d["last"] - F.greatest(acc["end"] + 1, d["first"]) + 1))
            .alias("n")), lambda acc: acc["n"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["first"])).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("detections")).alias("labels"),
        F.when(F.col("n_words") > 0, covered / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"))
