"""License scans: ordered signature rules on words, gated by keywords, resolved by priority and interval containment."""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .runtime import prepare, table

#: ASCII bytes that belong to no word become a space, A-Z becomes a-z; all other bytes belong to words.
FOLD = bytes(c if c > 127 or 97 <= c <= 122 or 48 <= c <= 57 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    #: A literal that every match contains.
    keyword: str
    #: A pattern over lower-case words with one space between them and at both ends of the text; a group `own`, if any,
    #: is what the detection covers.
    pattern: str


# Texts that only one license, or one family of them, contains. (label, keyword, pattern)
SIGNATURES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission to use copy modify and or distribute this software", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", "permission to use copy modify and or distribute", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "may be used to endorse or promote products", r"neither the name of (?:\S+ ){1,12}?nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising materials mentioning features", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2", "unless required by applicable law or agreed to in writing", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-1.1", "products derived from this software may not be called apache", r"products derived from this software may not be called apache"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license", r"redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2", "either version 2 of the license", r"gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3", "either version 3 of the license", r"gnu general public license as published by the free software foundation either version 3 of the license"),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu l", r"redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl-2.1", "either version 2 1 of the license", r"gnu lesser general public license as published by the free software foundation either version 2 1 of the license"),
    ("lgpl-3", "lesser general public license as published", r"gnu lesser general public license as published by the free software foundation either version 3 of the license"),
    ("agpl-3", "affero general public license as published", r"gnu affero general public license as published by the free software foundation either version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "subject to the mozilla public license version 1 1", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-2", "made available under the terms of the eclipse public license", r"made available under the terms of the eclipse public license 2 0"),
    ("epl-1", "made available under the terms of the eclipse public license v1", r"made available under the terms of the eclipse public license v1 0"),
    ("cddl-1", "common development and distribution license", r"subject to the terms of the common development and distribution license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the fuck you want to public license", r"do what the fuck you want to public license"),
    ("zlib", "will the authors be held liable for any damages arising from the use of this software", r"in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone"),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("ofl-1.1", "sil open font license", r"this font software is licensed under the sil open font license version 1 1"),
    ("python-2", "python software foundation license version 2", r"python software foundation license version 2"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("ncsa", "deal with the software without restriction", r"permission is hereby granted free of charge (?:\S+ ){1,20}?to deal with the software without restriction"),
    ("cc0-1", "waived all copyright and related", r"has waived all copyright and related or neighboring rights"),
    ("public-domain", "public domain", r"(?:is|are|been|placed|released|dedicated|put)(?: \S+){0,3} (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"public domain (?:dedication|mark|work|software)"),
    ("proprietary", "all rights reserved", r"copyright (?:\S+ ){1,10}?all rights reserved"),
    ("proprietary", "may not be", r"may not be (?:copied|reproduced|distributed)(?: \S+){0,8} without (?:\S+ ){0,4}(?:licen[sc]e|permission)"),
    ("no-warranty", "warranty", r"without warranty of any kind(?: express or implied)?"),
    ("copyleft", "copyleft", r"copyleft (?:licen[sc]e|licensed)"),
]

# Names of licenses and their versions as words. (label, name, versions)
NAMES = [
    ("gpl", "(?:gnu )?general public licen[sc]e|gnu gpl|gpl", "1 2 3"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public licen[sc]e|gnu lgpl|lgpl", "2 2.1 3"),
    ("agpl", "(?:gnu )?affero general public licen[sc]e|gnu agpl|agpl", "1 3"),
    ("fdl", "gnu free documentation licen[sc]e|gnu fdl|gfdl", "1.1 1.2 1.3"),
    ("apache", "apache (?:software )?licen[sc]e", "1 1.1 2"),
    ("mpl", "mozilla public licen[sc]e", "1 1.1 2"),
    ("epl", "eclipse public licen[sc]e", "1 2"),
    ("cddl", "common development and distribution licen[sc]e", "1 1.1"),
    ("eupl", "european union public licen[sc]e", "1 1.1 1.2"),
    ("afl", "academic free licen[sc]e", "1.1 2 2.1 3"),
    ("osl", "open software licen[sc]e", "1 2 2.1 3"),
    ("artistic", "artistic licen[sc]e", "1 2"),
    ("bsl", "boost software licen[sc]e", "1"),
    ("ofl", "(?:sil )?open font licen[sc]e", "1 1.1"),
    ("cecill", "cecill(?: free software)? licen[sc]e", "1 1.1 2 2.1"),
    ("odbl", "open (?:data commons open )?database licen[sc]e", "1"),
    ("odc-by", "open data commons attribution licen[sc]e", "1"),
    ("pddl", "(?:open data commons )?public domain dedication and licen[sc]e", "1"),
    ("busl", "business source licen[sc]e", "1.1"),
    ("sspl", "server side public licen[sc]e", "1"),
    ("elastic", "elastic licen[sc]e", "1 2"),
    ("polyform-nc", "polyform noncommercial licen[sc]e", "1"),
    ("zpl", "zope public licen[sc]e", "1.1 2 2.1"),
    ("php", "php licen[sc]e", "3 3.01"),
    ("python", "python (?:software foundation )?licen[sc]e", "2"),
    ("lppl", "latex project public licen[sc]e", "1 1.1 1.2 1.3"),
    ("ms-pl", "microsoft public licen[sc]e", ""),
    ("ms-rl", "microsoft reciprocal licen[sc]e", ""),
    ("mit", "mit (?:open source )?licen[sc]e|expat licen[sc]e|x11 licen[sc]e", ""),
    ("mit-0", "mit no attribution licen[sc]e|mit 0 licen[sc]e", ""),
    ("isc", "isc licen[sc]e", ""),
    ("bsd", "bsd(?: style)? licen[sc]e", ""),
    ("bsd-2-clause", "(?:simplified|freebsd|bsd 2 clause|2 clause bsd|two clause bsd) licen[sc]e", ""),
    ("bsd-3-clause", "(?:revised bsd|new bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd) licen[sc]e", ""),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd) licen[sc]e", ""),
    ("zlib", "zlib(?: libpng)? licen[sc]e", ""),
    ("unlicense", "(?:the )?unlicense(?: licen[sc]e)?", ""),
    ("wtfpl", "wtfpl(?: licen[sc]e)?(?: public licen[sc]e)?", ""),
    ("beerware", "beer ?ware licen[sc]e", ""),
    ("postgresql", "postgresql licen[sc]e", ""),
    ("ncsa", "(?:university of illinois )?ncsa (?:open source )?licen[sc]e", ""),
    ("ruby", "ruby licen[sc]e", ""),
    ("vim", "vim licen[sc]e", ""),
    ("openssl", "openssl licen[sc]e", ""),
    ("json", "json licen[sc]e", ""),
    ("blueoak", "blue oak model licen[sc]e", "1"),
    ("hippocratic", "hippocratic licen[sc]e", "1 2 3"),
    ("mulan", "mulan permissive software licen[sc]e", "1 2"),
    ("upl", "universal permissive licen[sc]e", "1"),
    ("sleepycat", "sleepycat licen[sc]e", ""),
    ("qpl", "q public licen[sc]e", "1"),
    ("ipl", "ibm public licen[sc]e", "1"),
    ("cpl", "common public licen[sc]e", "1"),
    ("npl", "netscape public licen[sc]e", "1 1.1"),
    ("apsl", "apple public source licen[sc]e", "1 1.1 2"),
    ("openrail", "(?:creativeml )?open ?rail(?: \\w)? licen[sc]e", ""),
    ("llama", "llama(?: 2| 3)? community licen[sc]e", ""),
    ("ogl-uk", "open government licen[sc]e", "1 2 3"),
    ("etalab", "licen[sc]e ouverte", "1 2"),
]

# Parts of the attribution family: (label, words)
CREATIVE = [
    ("by", "attribution"),
    ("by-sa", "attribution share ?alike"),
    ("by-nd", "attribution no ?deriv(?:ative)?s?"),
    ("by-nc", "attribution non ?commercial"),
    ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?"),
]

# Licenses as people write them: identifiers, abbreviations, adjectives, notices. (label, confidence, keyword, pattern)
PHRASES = [
    ("mit", 0.8, "mit licensed", r"mit licensed"),
    ("mit", 0.7, "mit style", r"mit style(?: licen[sc]e)?"),
    ("mit", 0.7, "mit x11", r"mit x11(?: licen[sc]e)?"),
    ("mit", 0.7, "expat", r"(?:licensed|released|distributed|available) under (?:the )?expat"),
    ("mit", 0.7, "under mit", r"(?:licensed|released|distributed|available|published) under mit"),
    ("mit", 0.7, "mit or apache", r"mit or apache"),
    ("mit", 0.6, "licen", r"licen[sc]e mit"),
    ("mit", 0.7, "mit licen", r"license[sd]? under (?:the )?mit licen[sc]e"),
    ("mit-0", 0.8, "mit 0", r"(?:licensed under|license|the) mit 0"),
    ("apache-2", 0.8, "apache 2", r"apache 2(?: 0)?(?: licen[sc]ed?)?"),
    ("apache-2", 0.8, "apache v2", r"apache v2(?: 0)?(?: licen[sc]ed?)?"),
    ("apache-2", 0.7, "asl 2", r"asl 2(?: 0)?"),
    ("apache-2", 0.7, "aslv2", r"aslv2"),
    ("apache-2", 0.8, "apache org licenses", r"apache org licenses license 2(?: 0)?"),
    ("apache-1.1", 0.7, "apache 1 1", r"apache 1 1"),
    ("apache", 0.6, "apache licensed", r"apache licensed"),
    ("apache", 0.6, "apache style", r"apache style(?: licen[sc]e)?"),
    ("bsd-2-clause", 0.8, "bsd 2 clause", r"bsd 2 clause"),
    ("bsd-2-clause", 0.8, "2 clause bsd", r"2 clause bsd"),
    ("bsd-2-clause", 0.8, "two clause bsd", r"two clause bsd"),
    ("bsd-2-clause", 0.7, "simplified bsd", r"simplified bsd"),
    ("bsd-3-clause", 0.8, "bsd 3 clause", r"bsd 3 clause"),
    ("bsd-3-clause", 0.8, "3 clause bsd", r"3 clause bsd"),
    ("bsd-3-clause", 0.8, "three clause bsd", r"three clause bsd"),
    ("bsd-3-clause", 0.7, "modified bsd", r"modified bsd"),
    ("bsd-3-clause", 0.7, "new bsd", r"(?:under|the) new bsd"),
    ("bsd-4-clause", 0.8, "bsd 4 clause", r"bsd 4 clause"),
    ("bsd-4-clause", 0.8, "4 clause bsd", r"4 clause bsd"),
    ("bsd-1-clause", 0.8, "bsd 1 clause", r"bsd 1 clause"),
    ("bsd", 0.7, "bsd licensed", r"bsd licensed"),
    ("bsd", 0.6, "bsd style", r"bsd style"),
    ("bsd", 0.6, "under bsd", r"(?:licensed|released|distributed|available) under bsd"),
    ("0bsd", 0.8, "0bsd", r"0bsd"),
    ("0bsd", 0.8, "zero clause bsd", r"(?:bsd )?zero clause bsd"),
    ("gpl-2", 0.8, "gplv2", r"gplv2(?: 0)?"),
    ("gpl-3", 0.8, "gplv3", r"gplv3(?: 0)?"),
    ("gpl-1", 0.8, "gplv1", r"gplv1(?: 0)?"),
    ("gpl-2", 0.8, "gpl2", r"gpl2"),
    ("gpl-3", 0.8, "gpl3", r"gpl3"),
    ("gpl-2-or-later", 0.9, "gpl 2 0 or later", r"gpl 2 0 or later"),
    ("gpl-3-or-later", 0.9, "gpl 3 0 or later", r"gpl 3 0 or later"),
    ("gpl-2-or-later", 0.8, "2 of the license or at your option any later version", r"version 2 of the license or at your option any later version"),
    ("gpl-3-or-later", 0.8, "3 of the license or at your option any later version", r"version 3 of the license or at your option any later version"),
    ("gpl-2-only", 0.9, "gpl 2 0 only", r"gpl 2 0 only"),
    ("gpl-3-only", 0.9, "gpl 3 0 only", r"gpl 3 0 only"),
    ("gpl", 0.7, "gpl licensed", r"gpl licensed"),
    ("gpl", 0.6, "gpl compatible", r"gpl compatible"),
    ("gpl", 0.6, "gnu org", r"gnu org (?:licenses|copyleft) gpl"),
    ("gpl", 0.6, "gpl ed", r"gpl ed"),
    ("gpl-classpath", 0.9, "classpath exception", r"(?:gpl )?(?:with )?(?:the )?classpath exception"),
    ("gpl-linking", 0.8, "linking exception", r"gpl (?:\S+ ){0,4}?linking exception"),
    ("gpl-gcc", 0.8, "gcc runtime library exception", r"gcc runtime library exception"),
    ("gpl-font", 0.8, "font exception", r"gpl (?:\S+ ){0,4}?font exception"),
    ("lgpl-2.1", 0.8, "lgplv2 1", r"lgplv2 1"),
    ("lgpl-2", 0.7, "lgplv2", r"lgplv2"),
    ("lgpl-3", 0.8, "lgplv3", r"lgplv3"),
    ("lgpl", 0.7, "lgpl licensed", r"lgpl licensed"),
    ("lgpl-2.1-or-later", 0.9, "lgpl 2 1 or later", r"lgpl 2 1 or later"),
    ("agpl-3", 0.8, "agplv3", r"agplv3"),
    ("agpl-3", 0.8, "agpl3", r"agpl3"),
    ("agpl-3-or-later", 0.9, "agpl 3 0 or later", r"agpl 3 0 or later"),
    ("agpl", 0.7, "agpl licensed", r"agpl licensed"),
    ("mpl-2", 0.8, "mpl 2", r"mpl 2(?: 0)?"),
    ("mpl-1.1", 0.8, "mpl 1 1", r"mpl 1 1"),
    ("mpl-2", 0.8, "mplv2", r"mplv2(?: 0)?"),
    ("mpl-2", 0.8, "mpl was not distributed with this file", r"if a copy of the mpl was not distributed with this file"),
    ("mpl", 0.6, "mpl", r"(?:licensed|released|distributed|available|covered) (?:under|by) (?:the )?mpl"),
    ("epl-1", 0.8, "epl 1", r"epl 1(?: 0)?"),
    ("epl-2", 0.8, "epl 2", r"epl 2(?: 0)?"),
    ("epl-1", 0.8, "epl v1", r"epl v1(?: 0)?"),
    ("epl-2", 0.8, "epl v2", r"epl v2(?: 0)?"),
    ("edl-1", 0.8, "eclipse distribution licen", r"eclipse distribution licen[sc]e(?: v? ?1(?: 0)?)?"),
    ("cddl-1", 0.8, "cddl 1 0", r"cddl 1 0"),
    ("cddl-1.1", 0.8, "cddl 1 1", r"cddl 1 1"),
    ("cddl", 0.6, "cddl", r"(?:under|by) (?:the )?(?:terms of the )?cddl"),
    ("eupl-1.2", 0.8, "eupl 1 2", r"eupl 1 2"),
    ("eupl-1.1", 0.8, "eupl 1 1", r"eupl 1 1"),
    ("eupl", 0.6, "eupl", r"(?:under|by) (?:the )?(?:terms of the )?eupl"),
    ("artistic-2", 0.8, "artistic 2", r"artistic 2(?: 0)?"),
    ("artistic-1", 0.8, "artistic 1", r"artistic 1(?: 0)?"),
    ("artistic-perl", 0.8, "terms as perl", r"(?:under )?the same terms as perl(?: itself| 5)?"),
    ("ruby", 0.7, "terms as ruby", r"(?:under )?the same terms as ruby"),
    ("python", 0.7, "terms as python", r"(?:under )?the same terms as python"),
    ("python-2", 0.8, "psf 2", r"psf 2(?: 0)?"),
    ("python", 0.7, "psf licen", r"psf licen[sc]e"),
    ("python-cnri", 0.8, "cnri", r"cnri (?:open source )?(?:python )?licen[sc]e(?: agreement)?"),
    ("isc", 0.7, "isc licensed", r"isc licensed"),
    ("zlib", 0.7, "zlib licensed", r"zlib licensed"),
    ("zlib", 0.7, "altered source versions", r"altered source versions must be plainly marked as such"),
    ("libpng", 0.8, "libpng licen", r"libpng licen[sc]e(?: version)?(?: 2)?"),
    ("bsl-1", 0.8, "bsl 1", r"bsl 1(?: 0)?"),
    ("bsl-1", 0.7, "boost org license", r"boost org license 1 0(?: txt)?"),
    ("busl-1.1", 0.8, "bsl 1 1", r"bsl 1 1"),
    ("busl-1.1", 0.8, "busl 1 1", r"busl 1 1"),
    ("cc0-1", 0.8, "cc zero", r"cc zero"),
    ("cc0-1", 0.8, "publicdomain zero", r"creativecommons org publicdomain zero(?: 1 0)?"),
    ("cc0-1", 0.7, "no rights reserved", r"no rights reserved"),
    ("cc-by", 0.6, "attribution international", r"attribution international"),
    ("cc-by-4", 0.8, "attribution 4 0 international", r"attribution 4 0 international"),
    ("cc-by-sa-4", 0.8, "sharealike 4 0 international", r"attribution sharealike 4 0 international"),
    ("cc-by-nc-4", 0.8, "noncommercial 4 0 international", r"attribution noncommercial 4 0 international"),
    ("cc-by-nc-sa-4", 0.8, "noncommercial sharealike 4 0 international", r"attribution noncommercial sharealike 4 0 international"),
    ("cc-by-nc-nd-4", 0.8, "noncommercial noderivatives 4 0 international", r"attribution noncommercial noderivatives 4 0 international"),
    ("cc-by-nd-4", 0.8, "noderivatives 4 0 international", r"attribution noderivatives 4 0 international"),
    ("cc-by-sa-3", 0.8, "alike 3 0 unported", r"attribution share ?alike 3 0 unported"),
    ("cc-by-3", 0.8, "attribution 3 0 unported", r"attribution 3 0 unported"),
    ("cc", 0.5, "some rights reserved", r"some rights reserved"),
    ("cc", 0.4, "cc licensed", r"cc licensed"),
    ("unlicense", 0.8, "unlicense org", r"unlicense org"),
    ("unlicense", 0.7, "anyone is free to copy modify publish use", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 0.7, "do what the f", r"do what the f(?: \S+)? you want to"),
    ("beerware", 0.8, "the beer ware license", r"the beer ware license(?: revision 42)?"),
    ("beerware", 0.7, "buy me a beer in return", r"you can buy me a beer in return"),
    ("json", 0.8, "for good not evil", r"the software shall be used for good not evil"),
    ("openssl", 0.8, "openssl toolkit", r"for use in the openssl toolkit"),
    ("ssleay", 0.8, "eric young", r"written by eric young"),
    ("curl", 0.7, "curl licen", r"(?:the )?curl licen[sc]e"),
    ("icu", 0.7, "icu licen", r"(?:the )?icu licen[sc]e"),
    ("unicode", 0.7, "unicode licen", r"unicode licen[sc]e(?: agreement)?(?: v3)?"),
    ("w3c", 0.7, "w3c", r"w3c (?:software|document)(?: and document)?(?: notice and)? licen[sc]e"),
    ("hpnd", 0.7, "historical permission notice", r"historical permission notice and disclaimer"),
    ("ftl", 0.7, "freetype", r"(?:the )?freetype (?:project )?licen[sc]e"),
    ("ijg", 0.7, "independent jpeg group", r"(?:work of the )?independent jpeg group"),
    ("tcl", 0.7, "tcl", r"tcl(?: tk)? licen[sc]e"),
    ("ofl-1.1", 0.8, "ofl 1 1", r"(?:sil )?ofl 1 1"),
    ("ofl", 0.7, "reserved font name", r"with reserved font names?"),
    ("vim", 0.7, "charityware", r"charityware"),
    ("mulan-2", 0.8, "mulan psl", r"mulan psl ?v? ?2"),
    ("ms-pl", 0.8, "ms pl", r"(?:licensed under|license|the) ms pl"),
    ("ms-rl", 0.8, "ms rl", r"(?:licensed under|license|the) ms rl"),
    ("afl-3", 0.8, "afl 3", r"afl 3(?: 0)?"),
    ("osl-3", 0.8, "osl 3", r"osl 3(?: 0)?"),
    ("zpl-2.1", 0.8, "zpl 2 1", r"zpl 2 1"),
    ("sspl-1", 0.8, "sspl", r"sspl(?: v?1)?(?: 0)?"),
    ("elastic-2", 0.8, "elv2", r"elv2"),
    ("commons-clause", 0.9, "commons clause", r"commons clause(?: licen[sc]e)?(?: condition)?"),
    ("odbl-1", 0.8, "odbl", r"odbl(?: 1(?: 0)?)?"),
    ("pddl-1", 0.8, "pddl", r"pddl(?: 1(?: 0)?)?"),
    ("cdla", 0.8, "community data license agreement", r"community data license agreement(?: permissive| sharing)?"),
    ("openrail-m", 0.8, "openrail m", r"(?:creativeml )?openrail m"),
    ("bigscience-rail", 0.8, "bigscience rail", r"bigscience rail(?: licen[sc]e)?(?: v?1 0)?"),
    ("gemma", 0.7, "gemma terms of use", r"gemma terms of use"),
    ("fdl-1.3", 0.8, "gfdl 1 3", r"gfdl 1 3"),
    ("fdl", 0.7, "invariant sections", r"no invariant sections"),
    ("ogl-uk-3", 0.8, "ogl 3", r"ogl 3(?: 0)?"),
    ("public-domain", 0.6, "domaine public", r"(?:dans le )?domaine public"),
    ("public-domain", 0.6, "dominio p", r"dominio p(?:ú|u)blico"),
    ("public-domain", 0.6, "gemeinfrei", r"gemeinfrei"),
    ("proprietary", 0.6, "tous droits r", r"tous droits r(?:é|e)serv(?:é|e)s"),
    ("proprietary", 0.6, "todos los derechos reservados", r"todos los derechos reservados"),
    ("proprietary", 0.6, "alle rechte vorbehalten", r"alle rechte vorbehalten"),
    ("proprietary", 0.6, "proprietary and confidential", r"proprietary and confidential"),
    ("proprietary", 0.6, "is strictly prohibited", r"unauthori[sz]ed (?:copying|use|distribution) (?:\S+ ){0,12}?is strictly prohibited"),
    ("proprietary", 0.6, "trade secret", r"trade secrets? of"),
    ("proprietary", 0.5, "end user license agreement", r"end user license agreement"),
    ("noncommercial", 0.5, "non commercial use only", r"(?:for )?non commercial use only"),
    ("noncommercial", 0.5, "noncommercial use only", r"(?:for )?noncommercial use only"),
    ("research-only", 0.5, "research purposes only", r"(?:for )?research purposes only"),
    ("research-only", 0.5, "academic use only", r"(?:for )?academic use only"),
    ("personal-use", 0.5, "personal use only", r"(?:for )?personal use only"),
    ("educational-use", 0.5, "educational use only", r"(?:for )?educational use only"),
    ("free-use", 0.4, "freely redistribut", r"may be freely redistribut(?:ed|able)"),
    ("free-use", 0.4, "free for any use", r"free for any use"),
    ("free-use", 0.4, "royalty free", r"royalty free licen[sc]e"),
    ("no-warranty", 0.3, "no warranty", r"absolutely no warranty"),
    ("no-warranty", 0.3, "as is", r"provided as is without"),
    ("see-license-file", 0.3, "license file", r"see (?:the )?license file"),
    ("see-license-file", 0.3, "file license", r"see (?:the )?file license"),
    ("see-license-file", 0.3, "copying", r"see (?:the )?(?:file )?copying"),
    ("dual", 0.4, "dual licen", r"dual licen[sc]ed?"),
    ("permissive", 0.3, "permissive", r"permissive(?:ly)? licen[sc]ed?"),
    ("open-source", 0.3, "open source licen", r"open source licen[sc]es?"),
]

# What denies a license: names within are no detections. (keyword, pattern)
DENIALS = [
    ("not ", r"(?:is|are|was|were|been) not (?:\S+ )?(?:licensed|released|distributed|available|covered|published|provided) (?:under|by) (?:\S+ ){0,7}?(?:licen[sc]es?|[al]?gpl|mpl|epl|cddl|eupl|bsd|mit|apache)(?: licen[sc]es?)?(?: (?:v|version)? ?\d(?: \d)?)?"),
    ("not ", r"not (?:licensed|released) (?:under|by) (?:\S+ ){0,7}?(?:licen[sc]es?|[al]?gpl|mpl|epl|cddl|eupl|bsd|mit|apache)(?: licen[sc]es?)?(?: (?:v|version)? ?\d(?: \d)?)?"),
    ("no longer", r"no longer (?:licensed|released|distributed|available|covered|published|provided) (?:under|by) (?:\S+ ){0,7}?(?:licen[sc]es?|[al]?gpl|mpl|epl|cddl|eupl|bsd|mit|apache)(?: licen[sc]es?)?(?: (?:v|version)? ?\d(?: \d)?)?"),
    ("never", r"never (?:licensed|released|distributed|published) (?:under|by) (?:\S+ ){0,7}?(?:licen[sc]es?|[al]?gpl|mpl|epl|cddl|eupl|bsd|mit|apache)(?: licen[sc]es?)?(?: (?:v|version)? ?\d(?: \d)?)?"),
    ("incompatible with", r"incompatible with (?:\S+ ){0,7}?(?:licen[sc]es?|[al]?gpl|mpl|epl|cddl|eupl)(?: licen[sc]es?)?(?: (?:v|version)? ?\d(?: \d)?)?"),
]

VERSION = r"(?: v| version| ver)? ?"


def _spoken(version: str) -> str:
    """A version as words: 2 also as 2 0, 2.1 as 2 1."""
    return version.replace(".", " ") if "." in version else rf"{version}(?: 0)?"


def _by_keyword(name: str) -> list[tuple[str, str]]:
    """The alternatives of a name as (keyword, alternatives that contain it): each has a literal of its own."""
    out: dict[str, list[str]] = {}
    for one in re.split(r"\|(?![^()]*\))", name):
        bare = re.sub(r"\(\?:[^()]*\)\??", "", one)  # what no group makes optional
        out.setdefault("licen" if "licen" in bare else "gpl" if "gpl" in bare else bare.strip(), []).append(one)
    return [(keyword, "|".join(some)) for keyword, some in out.items()]


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order: denials (without a label), signatures, names with a version, identifiers and phrases, names alone. A smaller priority wins."""
    out = [Rule("", 0, 0.0, keyword, pattern) for keyword, pattern in DENIALS]
    out += [Rule(label, 1, 0.95, keyword, pattern) for label, keyword, pattern in SIGNATURES]
    out += [Rule(label, 4, confidence, keyword, pattern) for label, confidence, keyword, pattern in PHRASES]
    for label, names, versions in NAMES:
        for v in versions.split():
            out += [Rule(f"{label}-{v}", 2, 0.9, word, rf"(?:{name}){VERSION}{_spoken(v)}(?! \d)") for word, name in _by_keyword(names)]
            out.append(Rule(f"{label}-{v}", 3, 0.9, "spdx", rf"spdx license identifier {re.escape(label).replace(r'\-', ' ')} {_spoken(v)}(?: only| or later)?"))
        out.append(Rule(label, 4, 0.8, "spdx", rf"spdx license identifier {re.escape(label).replace(r'\-', ' ')}"))
        for word, name in _by_keyword(names):
            out.append(Rule(label, 5, 0.7, word, rf"(?:licensed|released|distributed|available|published|provided|covered)(?: \S+){{0,3}} (?:under|by)(?: the)?(?: terms of the)? (?P<own>{name})"))
            out.append(Rule(label, 6, 0.6, word, rf"(?:{name})"))
        out.append(Rule(label, 5, 0.7, "opensource org", rf"opensource org licenses? {re.escape(label).replace(r'\-', ' ')}"))
    for part, words in CREATIVE:
        short = part.replace("-", " ")
        for v in ("1", "2", "2.5", "3", "4"):
            out.append(Rule(f"cc-{part}-{v}", 2, 0.9, " cc ", rf"cc {short} {_spoken(v)}(?! \d)"))
            out.append(Rule(f"cc-{part}-{v}", 2, 0.9, "creative commons", rf"creative commons {words} {_spoken(v)}(?! \d)"))
            out.append(Rule(f"cc-{part}-{v}", 2, 0.9, "licen", rf"creativecommons org licenses {short} {_spoken(v)}"))
        out.append(Rule(f"cc-{part}", 5, 0.7, " cc ", rf"cc {short}"))
        out.append(Rule(f"cc-{part}", 5, 0.7, "creative commons", rf"creative commons {words}(?: licen[sc]e)?"))
    out.append(Rule("cc0-1", 2, 0.9, "cc0", r"cc0(?: 1(?: 0)?)?(?: universal)?"))
    out.append(Rule("cc", 7, 0.4, "creative commons", r"creative commons(?: licen[sc]e)?"))
    out.append(Rule("unknown", 8, 0.3, "licen", r"(?:licensed|released|distributed) under (?:the )?(?:terms of (?:the )?)?(?P<own>(?:\S+ ){1,5}?licen[sc]e)"))
    out.append(Rule("unknown", 9, 0.2, "spdx", r"spdx license identifier \S+"))
    return tuple(out)


@cache
def _ready() -> tuple[ahocorasick.Automaton, list[list[tuple[Rule, re.Pattern]]]]:
    """The automaton that finds all keywords in one pass (over bytes as characters of Latin-1), and each keyword's rules."""
    gated: dict[str, list] = {}
    for rule in rules():
        gated.setdefault(rule.keyword.encode().decode("latin-1"), []).append((rule, re.compile(rb"(?<= )(?:" + rule.pattern.encode() + rb")(?= )")))
    automaton = ahocorasick.Automaton()
    for i, keyword in enumerate(gated):
        automaton.add_word(keyword, i)
    automaton.make_automaton()
    return automaton, [*gated.values()]


class Found(NamedTuple):
    label: str
    start: int
    end: int
    priority: int
    confidence: float


def resolved(found: list[Found]) -> list[Found]:
    """Detections without those whose interval lies within that of one before them, in the order of priority, then length, place and label.

    A Fenwick tree keeps, for each start among those so far, the furthest end of an interval that begins there or before, so each detection takes
    logarithmic time.
    """
    starts = sorted({f.start for f in found})
    rank = {x: i + 1 for i, x in enumerate(starts)}
    tree = [-1] * (len(starts) + 1)
    kept: list[Found] = []
    for f in sorted(found, key=lambda f: (f.priority, f.start - f.end, f.start, f.label)):
        x, furthest = rank[f.start], -1
        while x:
            furthest = max(furthest, tree[x])
            x -= x & -x
        if furthest < f.end:
            kept.append(f)
            x = rank[f.start]
            while x < len(tree):
                tree[x] = max(tree[x], f.end)
                x += x & -x
    return sorted(kept, key=lambda f: (f.start, f.end, f.label))


def detections(words: bytes) -> list[Found]:
    """Detections in a text given as words with one space between them and at both ends; starts and ends are bytes.

    Rules whose keyword the text has are tried; a detection within another one of smaller or equal priority is suppressed. What a denial covers
    isn't detected, nor is the denial itself.
    """
    automaton, gated = _ready()
    found = []
    for i in sorted({i for _, i in automaton.iter(words.decode("latin-1"))}):
        for rule, pattern in gated[i]:
            own = "own" if pattern.groupindex else 0
            found += [Found(rule.label, *m.span(own), rule.priority, rule.confidence) for m in pattern.finditer(words)]
    return [f for f in resolved(found) if f.label]


def scan(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of a text."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
    words = b" " + b" ".join(parts) + b" " if parts else b" "
    starts, base = [], set()
    for phrase, label in BASE.items():
        needle = f" {phrase} ".encode()
        at = words.find(needle)
        while at >= 0:
            starts.append(at)
            base.add(label)
            at = words.find(needle, at + 1)
    found = detections(words) if parts else []
    best: dict[str, float] = {}
    for f in found:
        best[f.label] = max(f.confidence, best.get(f.label, 0.0))
    miss = 1.0
    for label in sorted(best):
        miss *= 1 - best[label]
    score = max(1 - miss, 0.9 if base else 0.0)
    first, last = (words.count(b" ", 0, x) for x in (min(starts), max(starts))) if starts else (None, None)
    return len(parts), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(base | set(best))), score


def _scan(batches):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    for batch in batches:
        rows = list(zip(*map(scan, batch.column(1).to_pylist()), strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(x), k) for x, k in zip(rows, kinds, strict=True))], names=["doc_id", *names])


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id and scan()'s values for each row of docs (doc_id, text; other columns are ignored). A null text is empty: no words,
    no places, empty labels, score 0. Texts are scanned whole, in time that grows with their length and the logarithm of their detections. Repeated rows are scanned each; an empty table gives an empty one."""
    prepare(docs.sparkSession)
    fields = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(_scan, fields)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
