"""Signature rules of the license scan.

A pattern is a regular expression over lower-cased words (ASCII letters, ASCII digits and all other scripts; a space
stands between two words, "2.0" is the words "2 0"). The keyword of a rule is a part of all that its pattern matches.
Priority: 4 the text of a license, 3 a grant or an identifier, 2 a title with its version, 1 a title, 0 a mention.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float


#: The phrases that are counted at each place, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: What leads to a license's name in a grant, and what follows a name in one.
GRANT = "(?:released|licen[sc]ed|distributed|available|published|provided|offered|issued|shared|covered|governed|made available)"
UNDER = "(?:under|by|in accordance with|subject to|pursuant to)(?: the)?(?: terms)?(?: and conditions)?(?: of)?(?: the| an?)?"
LICENSE = "licen[sc]e"
WEIGHTS = {4: 1.0, 3: 0.9, 2: 0.75, 1: 0.6, 0: 0.3}

#: label, keyword, title, SPDX identifiers as words. The four forms of `_family` are made of each.
FAMILIES = (
    ("gpl-1", "gnu", "gnu (?:general public license|gpl) (?:version |v)?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2", "gnu", "gnu (?:general public license|gpl)(?: as published by the free software foundation)? (?:version |v)?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "gnu", "gnu (?:general public license|gpl)(?: as published by the free software foundation)? (?:version |v)?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "gnu", "gnu (?:lesser|library) general public license (?:version |v)?2(?: 1| 0)?", "lgpl 2 [01](?: only| or later)?"),
    ("lgpl-3", "gnu", "gnu lesser general public license (?:version |v)?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3", "gnu", "gnu affero general public license(?: version| v)? ?3?(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl", "gnu", "gnu free documentation license(?: version)?(?: 1 [123])?", "gfdl 1 [123](?: only| or later)?"),
    ("apache-1.1", "apache", "apache (?:software )?license (?:version |v)?1 [01]", "apache 1 [01]"),
    ("apache-2.0", "apache", "apache (?:software )?license (?:version |v)?2(?: 0)?", "apache 2 0"),
    ("mit", "mit licen", "(?:the )?mit licen[sc]e", "mit"),
    ("mit-0", "mit no attribution", "mit no attribution(?: license)?", "mit 0"),
    ("x11", "x11 licen", "x11 licen[sc]e", "x11"),
    ("bsd-0", "bsd", "zero clause bsd(?: license)?", "0bsd"),
    ("bsd-2", "bsd", "(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)(?: license)?", "bsd 2 clause"),
    ("bsd-3", "bsd", "(?:bsd (?:3|three) clause|(?:3|three) clause bsd|(?:new|modified|revised) bsd)(?: license)?", "bsd 3 clause"),
    ("bsd-4", "bsd", "(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)(?: license)?", "bsd 4 clause"),
    ("isc", "isc licen", "isc licen[sc]e", "isc"),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? 1 [01]", "mpl 1 [01]"),
    ("mpl-2.0", "mozilla", "mozilla public license(?: version| v)? 2(?: 0)?", "mpl 2 0"),
    ("epl-1.0", "eclipse public", "eclipse public license(?: version| v)? 1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse public", "eclipse public license(?: version| v)? 2(?: 0)?", "epl 2 0"),
    ("cddl-1.0", "development and distribution", "common development and distribution license(?: version)?(?: 1 [01])?", "cddl 1 [01]"),
    ("cpl-1.0", "common public", "common public license(?: version)?(?: 1 0)?", "cpl 1 0"),
    ("eupl-1.2", "european union public", "european union public licen[sc]e(?: version| v)?(?: 1 [12])?", "eupl 1 [12]"),
    ("artistic-2.0", "artistic", "artistic license(?: version)?(?: [12] 0)?", "artistic [12] 0"),
    ("boost-1.0", "boost", "boost software license(?: version)?(?: 1 0)?", "bsl 1 0"),
    ("busl-1.1", "business source", "business source license(?: version)?(?: 1 1)?", "busl 1 1"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e", "zlib"),
    ("libpng", "libpng", "libpng licen[sc]e", "libpng(?: 2 0)?"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl(?: license)?", "wtfpl"),
    ("openssl", "openssl", "openssl licen[sc]e", "openssl"),
    ("psf-2.0", "python software foundation", "python software foundation license(?: version 2)?", "psf 2 0"),
    ("php-3.01", "php license", "php license(?: version)?(?: 3 01| 3 0)?", "php 3 01?"),
    ("ruby", "ruby licen", "ruby licen[sc]e", "ruby"),
    ("ofl-1.1", "sil open font", "sil open font license(?: version)?(?: 1 [01])?", "ofl 1 [01]"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl"),
    ("sspl-1.0", "server side public", "server side public license(?: version)?(?: 1)?", "sspl 1 0"),
    ("elastic-2.0", "elastic license", "elastic license(?: version)?(?: 2 0| 2)?", "elastic 2 0"),
    ("upl-1.0", "universal permissive", "universal permissive license(?: version)?(?: v)?(?: 1 0)?", "upl 1 0"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source license", "ncsa"),
    ("postgresql", "postgresql", "postgresql licen[sc]e", "postgresql"),
    ("odbl-1.0", "database license", "open (?:data commons open )?database license(?: version| v)?(?: 1 0)?", "odbl 1 0"),
    ("odc-by-1.0", "commons attribution license", "open data commons attribution license(?: version| v)?(?: 1 0)?", "odc by 1 0"),
    ("pddl-1.0", "public domain dedication", "public domain dedication and license(?: 1 0)?", "pddl 1 0"),
    ("cdla-permissive", "community data", "community data license agreement(?: permissive)?(?: version)?(?: [12] 0)?", "cdla permissive [12] 0"),
    ("cc0", "cc0", "cc0(?: universal)?(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "creative commons", "creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?(?: license)?", "cc by [1234] [05]"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?(?: license)?", "cc by sa [1234] [05]"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)?(?: license)?", "cc by nc [1234] [05]"),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(?:ative|s|atives)?(?: works)?(?: [1234] [05])?(?: international| unported| generic)?(?: license)?", "cc by nd [1234] [05]"),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported| generic)?(?: license)?", "cc by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "creative commons", "creative commons attribution non ?commercial no ?deriv(?:ative|s|atives)?(?: works)?(?: [1234] [05])?(?: international| unported| generic)?(?: license)?", "cc by nc nd [1234] [05]"),
    ("bigscience-openrail", "openrail", "(?:creativeml |bigscience |bigcode )?openrail(?: m)?(?: license)?", "openrail(?: m)?"),
    ("beerware", "beerware", "beerware(?: license)?", "beerware"),
    ("ecl-2.0", "educational community", "educational community license(?: version)?(?: 2 0)?", "ecl 2 0"),
    ("osl-3.0", "open software license", "open software license(?: version| v)?(?: 3 0)?", "osl 3 0"),
    ("afl-3.0", "academic free", "academic free license(?: version| v)?(?: 3 0)?", "afl 3 0"),
    ("vim", "vim licen", "vim licen[sc]e", "vim"),
)

#: Sentences and short forms that no family makes: label, keyword, pattern, priority.
PHRASES = (
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 4),
    ("mit", "substantial portions", "shall be included in all copies or substantial portions of the software", 4),
    ("isc", "without fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 4),
    ("bsd-2", "redistributions", "redistributions of source code must retain the above copyright notice", 4),
    ("bsd-2", "redistributions", "redistributions in binary form must reproduce the above copyright notice", 4),
    ("bsd-3", "contributors may be used", "neither the name of (?:the )?[^ ]+(?: [^ ]+){0,6}? nor the names of its contributors may be used", 4),
    ("bsd-4", "advertising", "all advertising materials mentioning features or use of this software must display", 4),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license", 4),
    ("apache-2.0", "www apache org", "www apache org licenses license 2 0(?: html| txt)?", 3),
    ("gpl", "gnu", "either version [123](?: of the license)? or at your option any later version", 4),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license", 4),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 4),
    ("agpl-3", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license", 4),
    ("gpl", "warranty", "but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", 4),
    ("gpl", "gnu", "gnu org licenses gpl(?: [23] 0)?(?: html| txt)?", 3),
    ("lgpl", "gnu", "gnu org licenses lgpl(?: [23] [01])?(?: html| txt)?", 3),
    ("agpl-3", "gnu", "gnu org licenses agpl(?: 3 0)?(?: html| txt)?", 3),
    ("gpl-3", "gplv3", "gplv3", 2),
    ("gpl-2", "gplv2", "gplv2", 2),
    ("lgpl-3", "lgplv3", "lgplv3", 2),
    ("lgpl-2.1", "lgplv2", "lgplv2(?: 1)?", 2),
    ("agpl-3", "agplv3", "agplv3", 2),
    ("gpl", "gpl", "gnu gpl", 1),
    ("gpl", "gpl", "gpl licen[sc]e", 1),
    ("lgpl", "lgpl", "gnu lgpl", 1),
    ("lgpl", "gnu", "gnu (?:lesser|library) general public license", 1),
    ("agpl", "affero", "affero general public license", 1),
    ("mpl", "mozilla", "mozilla public license", 1),
    ("mpl-2.0", "mozilla", "mozilla org mpl 2 0", 3),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license", 4),
    ("epl", "eclipse public", "eclipse public license", 1),
    ("bsd", "bsd", "bsd licen[sc]e", 1),
    ("bsd", "bsd", "bsd style licen[sc]e", 1),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1234] [05]", 3),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1234] [05]", 3),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1234] [05]", 3),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1234] [05]", 3),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1234] [05]", 3),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1234] [05]", 3),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero 1 0", 3),
    ("cc-by-sa", "cc by", "cc by sa", 1),
    ("cc-by-nc", "cc by", "cc by nc", 1),
    ("cc-by-nd", "cc by", "cc by nd", 1),
    ("cc-by-nc-sa", "cc by", "cc by nc sa", 1),
    ("cc-by-nc-nd", "cc by", "cc by nc nd", 1),
    ("creative-commons", "creative commons", "creative commons licen[sc]e", 1),
    ("public-domain", "public domain", "(?:released|dedicated|placed) (?:in|in to|into|to) the public domain", 3),
    ("public-domain", "public domain", "this (?:work|text|file|image|document) is in the public domain", 3),
    ("public-domain", "unencumbered", "free and unencumbered software released into the public domain", 4),
    ("unlicense", "unlicense", "unlicense org", 3),
    ("wtfpl", "want to public license", "do what the fuck you want to public license", 4),
    ("ofl-1.1", "scripts sil", "scripts sil org ofl", 3),
    ("boost-1.0", "boost", "www boost org license 1 0 txt", 3),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented", 4),
    ("artistic-2.0", "artistic", "perl artistic license", 1),
    ("proprietary", "rights reserved", "all rights reserved", 0),
    ("proprietary", "reproduced", "no part of this (?:publication|book|work|document) may be reproduced", 3),
    ("proprietary", "confidential", "proprietary and confidential", 3),
    ("proprietary", "permission", "(?:without|except with)(?: the)?(?: prior)?(?: express)? (?:written )?permission", 0),
    ("non-commercial", "commercial", "for non ?commercial (?:use|purposes) only", 3),
    ("non-commercial", "commercial", "not (?:be )?(?:used )?for commercial (?:use|purposes)", 3),
    ("research-only", "research", "for (?:academic )?research (?:use|purposes) only", 3),
    ("lizenz", "lizenz", "unter der lizenz [^ ]+", 1),
    ("licence-fr", "licence", "sous (?:la )?licence [^ ]+", 1),
    ("licencia", "licencia", "bajo (?:la )?licencia [^ ]+", 1),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", 0),
    ("see-license", "licen", "see (?:the )?license(?: file)? for (?:more )?(?:details|information)", 1),
    ("see-license", "licen", "license(?: md| txt)? file", 0),
)

#: Sentences of license texts, notices, short names and addresses, written out by family: label, keyword, pattern, priority.
NOTICES = (
    # Permissive licenses: MIT, X11, ISC, BSD and their kin.
    ("mit", "sublicense", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell", 4),
    ("mit", "noninfringement", "(?:warranties of )?merchantability fitness for a particular purpose and noninfringement", 4),
    ("mit", "copyright holders be liable", "in no event shall the authors or copyright holders be liable for any claim damages or other liability", 4),
    ("mit", "opensource", "(?:www )?opensource org licen[sc]es mit(?: license)?(?: php| html)?", 3),
    ("mit", "expat", "expat licen[sc]e", 1),
    ("mit", "mit x11", "mit x11(?: licen[sc]e)?", 2),
    ("mit", "mit style", "mit style licen[sc]e", 1),
    ("mit", "mit licensed", "mit licensed", 2),
    ("mit", "licensed mit", "licensed mit", 2),
    ("mit-0", "sublicense", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided", 4),
    ("x11", "x consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising", 4),
    ("x11", "copyright holder", "except as contained in this notice the names? of the above copyright holders? shall not be used in advertising", 4),
    ("isc", "and this permission notice", "provided that the above copyright notice and this permission notice appear in all copies", 4),
    ("isc", "disclaims", "the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness", 4),
    ("isc", "opensource", "(?:www )?opensource org licen[sc]es isc(?: license)?", 3),
    ("hpnd", "copyright notice appear", "that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation", 4),
    ("hpnd", "historical permission", "historical permission notice and disclaimer", 2),
    ("bsd-2", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", 4),
    ("bsd-2", "opensource", "(?:www )?opensource org licen[sc]es bsd 2 clause", 3),
    ("bsd-2", "bsd", "freebsd documentation license", 2),
    ("bsd-3", "endorse", "may be used to endorse or promote products derived from this software without (?:specific )?prior written permission", 4),
    ("bsd-3", "copyright holder nor", "neither the name of the copyright holder nor the names of (?:its )?contributors", 4),
    ("bsd-3", "contributors may be used", "neither the name of the university nor the names of its contributors may be used", 4),
    ("bsd-3", "opensource", "(?:www )?opensource org licen[sc]es bsd 3 clause", 3),
    ("bsd-3", "bsd style license that can be found", "use of this source code is governed by a bsd style license that can be found in the license file", 4),
    ("bsd-3-clear", "patent", "no express or implied licenses to any (?:party s|partys) patent rights are granted by this license", 4),
    ("bsd-3-clear", "clear bsd", "(?:the )?clear bsd license", 2),
    ("bsd-4", "includes software developed", "this product includes software developed by (?:the )?[^ ]+(?: [^ ]+){0,8}? and its contributors", 4),
    ("bsd-patent", "bsd", "bsd (?:2 clause )?plus patent license", 2),
    ("bsd", "regents", "copyright (?:c )?(?:[0-9]+ ){0,4}the regents of the university of california", 3),
    ("bsd", "bsd type", "bsd (?:type|like) licen[sc]e", 1),
    ("bsd", "berkeley software", "berkeley software distribution licen[sc]e", 1),
    ("bsd-0", "permission to use copy", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", 4),
    ("zlib", "warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", 4),
    ("zlib", "misrepresented", "altered source versions must be plainly marked as such and must not be misrepresented", 4),
    ("libpng", "png", "the png reference library is supplied as is", 4),
    ("libpng", "pngcrush", "pngcrush licen[sc]e", 2),
    ("boost-1.0", "machine executable", "unless such copies or derivative works are solely in the form of machine executable object code", 4),
    ("boost-1.0", "boost software license", "distributed under the boost software license", 3),
    ("ncsa", "restriction", "to deal with the software without restriction including without limitation the rights to use copy modify merge", 4),
    ("ncsa", "champaign", "university of illinois at urbana champaign nor the names of its contributors may be used", 4),
    ("postgresql", "written agreement", "for any purpose without fee and without a written agreement is hereby granted", 4),
    ("upl-1.0", "software and the larger", "to make use sell offer for sale import export have made and have sold the software and the larger works?", 4),
    ("openssl", "openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit", 4),
    ("openssl", "cryptographic", "this product includes cryptographic software written by eric young", 4),
    ("curl", "curl licen", "curl licen[sc]e", 1),
    ("ntp", "ntp licen", "ntp licen[sc]e", 1),
    ("icu", "icu licen", "icu licen[sc]e", 1),
    ("unicode", "unicode", "unicode inc license agreement data files and software", 2),
    ("unicode", "unicode", "unicode (?:data files|terms of use) licen[sc]e", 1),
    ("w3c", "w3c", "w3c software (?:notice and )?(?:and document )?license", 2),
    ("json", "software shall be used for good", "the software shall be used for good not evil", 4),
    ("naist", "naist", "naist licen[sc]e", 1),
    ("blueoak-1.0", "blue oak model license", "blue oak model license(?: version)?(?: 1 0 0)?", 2),
    ("fair", "instrument", "usage of the works is permitted provided that this instrument is retained with the works", 4),
    ("afl-3.0", "academic free license", "licensed under the academic free license version 3 0", 3),
    ("imagemagick", "imagemagick", "imagemagick licen[sc]e", 1),
    ("bzip2", "bzip2", "bzip2 (?:and libbzip2 )?licen[sc]e", 1),
    ("ftl", "freetype", "freetype (?:project )?license", 2),
    ("ftl", "freetype", "portions of this software are copyright (?:c )?(?:[0-9]+ )?the freetype project", 4),
    ("ijg", "independent jpeg", "this software is based in part on the work of the independent jpeg group", 4),
    ("beerware", "beer", "(?:if we meet some day and you think this stuff is worth it )?you can buy me a beer in return", 4),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 4),
    ("unlicense", "distribute this software", "anyone is free to copy modify publish use compile sell or distribute this software", 4),
    ("wtfpl", "wtfpl", "www wtfpl net", 3),
    # Apache.
    ("apache-2.0", "distributed under the license", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 4),
    ("apache-2.0", "apache", "licensed to the apache software foundation asf under one or more contributor license agreements", 4),
    ("apache-2.0", "copyright ownership", "see the notice file distributed with this work for additional information regarding copyright ownership", 4),
    ("apache-2.0", "reproduction and distribution", "terms and conditions for use reproduction and distribution", 4),
    ("apache-2.0", "opensource", "(?:www )?opensource org licen[sc]es apache 2 0", 3),
    ("apache-2.0", "asl 2 0", "asl 2 0", 1),
    ("apache-2.0", "apache2", "apache2(?: 0)?(?: licen[sc]e)?", 1),
    ("apache-2.0", "apache v2", "apache v2(?: 0)?", 1),
    ("apache-2.0", "limitations under the license", "see the license for the specific language governing permissions and limitations under the license", 4),
    ("apache-1.1", "apache", "this product includes software developed by the apache (?:software foundation|group)", 4),
    ("apache", "apache style", "apache style licen[sc]e", 1),
    # GNU licenses.
    ("gpl", "redistribute", "this program is free software you can redistribute it and or modify", 4),
    ("gpl", "gnu", "you should have received a copy of the gnu general public license along with this (?:program|file|library|package)", 4),
    ("gpl", "gnu", "see the gnu general public license for more details", 4),
    ("gpl", "free software foundation", "write to the free software foundation inc (?:59|51|675) [^ ]+(?: [^ ]+){0,6}? (?:boston|cambridge)", 3),
    ("gpl", "gnu", "the gnu general public license is a free copyleft license", 4),
    ("gpl", "gpl", "dual licensed (?:under )?(?:the )?(?:mit|bsd|apache|mpl) (?:and|or) (?:the )?gpl", 3),
    ("gpl", "gpl compatible", "gpl compatible", 0),
    ("gpl", "gplv", "gplv[123] or (?:later|newer)", 2),
    ("gpl-2", "gpl v2", "gpl v2(?: 0)?(?: only)?", 2),
    ("gpl-2", "gnu", "under the terms of (?:the )?(?:version 2 of the )?gnu general public license(?: version 2)? as published by the free software foundation", 4),
    ("gpl-2", "gnu", "gnu general public license version 2 june 1991", 4),
    ("gpl-2-classpath", "classpath", "(?:gnu )?classpath exception", 2),
    ("gpl-2-classpath", "executable regardless", "permission to link this library with independent modules to produce an executable regardless of the license terms", 4),
    ("gpl-3", "gnu", "gnu general public license version 3 29 june 2007", 4),
    ("gpl-3", "gpl v3", "gpl v3(?: 0)?(?: only)?", 2),
    ("gpl-3", "gcc runtime", "gcc runtime library exception", 2),
    ("lgpl", "redistribute", "this library is free software you can redistribute it and or modify", 4),
    ("lgpl", "gnu", "you should have received a copy of the gnu (?:lesser|library) general public license", 4),
    ("lgpl", "gnu", "see the gnu (?:lesser|library) general public license for more details", 4),
    ("lgpl-2.1", "lgpl v2", "lgpl v2(?: 1)?", 2),
    ("lgpl-2.1", "gnu", "gnu lesser general public license version 2 1 february 1999", 4),
    ("lgpl-3", "lgpl v3", "lgpl v3", 2),
    ("lgpl-3", "gnu", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3", 4),
    ("agpl-3", "gnu", "you should have received a copy of the gnu affero general public license", 4),
    ("agpl-3", "gnu", "gnu affero general public license version 3 19 november 2007", 4),
    ("agpl-3", "interacting", "all users interacting with it remotely through a computer network", 4),
    ("agpl-3", "agpl v3", "agpl v3", 2),
    ("agpl", "agpl", "agpl licen[sc]ed?", 1),
    ("gfdl", "gnu", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 4),
    ("gfdl", "invariant sections", "with no invariant sections no front cover texts and no back cover texts", 4),
    ("gfdl", "gfdl", "gfdl", 1),
    # Mozilla, Eclipse and other weak copyleft.
    ("mpl-2.0", "distributed", "if a copy of the mpl was not distributed with this file you can obtain one at", 4),
    ("mpl-2.0", "licen", "licen[sc]ed (?:under )?(?:the )?mpl(?: v)? ?2(?: 0)?", 2),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license", 4),
    ("mpl-1.1", "mozilla", "mozilla org mpl (?:1 1|mpl 1 1)", 3),
    ("mpl-1.1", "gnu", "alternatively the contents of this file may be used under the terms of (?:either )?the gnu general public license", 4),
    ("epl-2.0", "eclipse", "(?:www )?eclipse org legal epl (?:2 0|v20)", 3),
    ("epl-1.0", "eclipse", "(?:www )?eclipse org legal epl (?:1 0|v10)", 3),
    ("epl", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license", 4),
    ("edl-1.0", "eclipse distribution", "eclipse distribution license(?: v| version)?(?: 1 0)?", 2),
    ("cddl-1.0", "distribution license", "the contents of this file are subject to the terms of the common development and distribution license", 4),
    ("cddl-1.0", "cddl", "cddl(?: v)?(?: 1 [01])?", 1),
    ("eupl-1.2", "eupl", "licensed under the eupl", 3),
    ("cecill-2.1", "cecill", "cecill(?: [bc])?(?: free software)?(?: license)?(?: agreement)?(?: version)?(?: 2 [01])?", 2),
    ("osl-3.0", "open software license", "licensed under the open software license version 3 0", 3),
    ("qpl-1.0", "q public", "q public license(?: version)?(?: 1 0)?", 2),
    ("sleepycat", "sleepycat", "sleepycat licen[sc]e", 1),
    ("artistic-1.0", "artistic", "the artistic license preamble the intent of this document is to state the conditions", 4),
    ("artistic-2.0", "perl", "same terms as perl itself", 3),
    ("perl", "perl", "you (?:may|can) redistribute it and or modify it under the same terms as perl(?: itself)?", 4),
    ("ofl-1.1", "reserved font name", "with reserved font names? [^ ]+", 3),
    ("ofl-1.1", "sil open font", "this font software is licensed under the sil open font license", 4),
    # Source available and model licenses.
    ("busl-1.1", "additional", "additional use grant", 2),
    ("busl-1.1", "change license", "change date [^ ]+(?: [^ ]+){0,4}? change license", 4),
    ("sspl-1.0", "sspl", "sspl(?: v1)?", 1),
    ("commons-clause", "commons clause", "commons clause (?:license condition|restriction)?(?: v1 0)?", 2),
    ("commons-clause", "sell the software", "does not grant to you the right to sell the software", 4),
    ("elastic-2.0", "managed service", "you may not provide the software to third parties as a hosted or managed service", 4),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict|perimeter|internal use) license(?: 1 0 0)?", 2),
    ("llama", "community license", "llama(?: [234](?: [0-9])?)? community license(?: agreement)?", 2),
    ("llama", "llama", "built with (?:meta )?llama", 3),
    ("gemma", "gemma", "gemma (?:terms of use|license)", 2),
    ("openrail", "responsible", "open responsible ai licen[sc]es?", 2),
    ("openrail", "based restrictions", "use based restrictions as referenced in", 4),
    # Creative Commons and open data.
    ("cc-by", "creative commons", "this work is licensed under a creative commons attribution(?: [1234] [05])?(?: international| unported)? license", 4),
    ("cc-by-sa", "creative commons", "this work is licensed under a creative commons attribution share ?alike", 4),
    ("cc-by-nc", "creative commons", "this work is licensed under a creative commons attribution non ?commercial", 4),
    ("cc0", "public domain", "the person who associated a work with this deed has dedicated the work to the public domain", 4),
    ("cc0", "cc zero", "cc zero", 1),
    ("cc0", "waived all copyright", "has waived all copyright and related or neighboring rights", 4),
    ("cc-by", "creative commons", "lizenziert unter (?:einer )?creative commons", 1),
    ("cc-by", "ccby", "ccby", 1),
    ("public-domain", "public domain mark", "public domain mark(?: 1 0)?", 2),
    ("public-domain", "gemeinfrei", "(?:ist|sind) gemeinfrei", 2),
    ("public-domain", "domaine public", "(?:dans le|du) domaine public", 2),
    ("public-domain", "dominio p", "(?:en el|de) dominio p[^ ]+blico", 2),
    ("odbl-1.0", "opendatacommons", "opendatacommons org licenses odbl", 3),
    ("odc-by-1.0", "opendatacommons", "opendatacommons org licenses by", 3),
    ("pddl-1.0", "opendatacommons", "opendatacommons org licenses pddl", 3),
    ("ogl-uk-3.0", "open government licen", "open government licen[sc]e(?: for public sector information)?(?: v| version)?(?: ?3(?: 0)?)?", 2),
    ("etalab-2.0", "licence ouverte", "licence ouverte(?: open licence)?(?: version)?(?: [12] 0)?", 2),
    ("dl-de-by-2.0", "datenlizenz", "datenlizenz deutschland(?: namensnennung)?(?: version)?(?: 2 0)?", 2),
    # Reservations and terms.
    ("proprietary", "vorbehalten", "alle rechte vorbehalten", 0),
    ("proprietary", "tous droits", "tous droits r[^ ]+serv[^ ]+s", 0),
    ("proprietary", "todos los derechos", "todos los derechos reservados", 0),
    ("proprietary", "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)(?: of this file)?(?: via any medium)? is strictly prohibited", 4),
    ("proprietary", "licen", "end user licen[sc]e agreement", 2),
    ("proprietary", "trade secret", "contains trade secrets? and proprietary information", 3),
    ("proprietary", "not be reproduced", "(?:may|shall) not be reproduced (?:copied |distributed |or )*(?:in whole or in part )?without", 3),
    ("non-commercial", "commercial", "(?:personal|educational) (?:and|or) non ?commercial use", 3),
    ("non-commercial", "commercial", "commercial use (?:is )?(?:strictly )?(?:prohibited|forbidden|not permitted)", 3),
    ("non-commercial", "kommerziell", "nur f[^ ]+r nicht kommerzielle zwecke", 3),
    ("research-only", "evaluation", "for evaluation (?:use|purposes) only", 3),
    ("no-ai-training", "train", "(?:may )?not (?:be )?used? (?:to|for) train(?:ing)? (?:of )?(?:artificial intelligence|ai|machine learning|language) (?:models?|systems?)", 3),
    ("no-derivatives", "derivative works", "(?:may|shall) not (?:create|prepare|make) derivative works", 3),
)


def _family(label: str, keyword: str, title: str, spdx: str) -> tuple[Rule, ...]:
    """A license's title, the grant that names it, its SPDX tag, and a metadata field that holds its identifier."""
    make = lambda word, pattern, priority: Rule(label, word, pattern, priority, WEIGHTS[priority])
    return (
        make(keyword, title, 2),
        make(keyword, f"{GRANT} {UNDER} {title}", 3),
        make("spdx", f"spdx license identifier {spdx}", 3),
        make("licen", f"licen[sc]e (?:is |type |name |id )?{spdx}", 1),
    )


RULES: tuple[Rule, ...] = (
    *(rule for family in FAMILIES for rule in _family(*family)),
    *(Rule(label, keyword, pattern, priority, WEIGHTS[priority]) for label, keyword, pattern, priority in PHRASES + NOTICES),
)
