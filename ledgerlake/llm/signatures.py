"""License signatures, written over normalised texts: lower-case words with one space between.

A line is: priority (0 to 100), keyword, regular expression. A rule runs only on texts that hold
its keyword as it stands; of hits inside one another the one of higher priority stays.
"""

from __future__ import annotations

from dataclasses import dataclass

# Phrases that every scan counts, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Signatures by label.
RULES = r"""
[mit]
95 | hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software
90 | above copyright notice | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
88 | without warranty of any kind | the software is provided as is without warranty of any kind express or implied
85 | mit licen | (?:is )?(?:released|licensed|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?mit licen[sc]e
84 | mit licen | the mit licen[sc]e mit
80 | mit licen | licen[sc]e mit licen[sc]e
75 | mit style | mit style licen[sc]e
75 | expat | expat licen[sc]e
75 | x11 | (?:x11|mit x11|x consortium) licen[sc]e
99 | spdx | spdx licen[sc]e identifier mit
60 | licen | licen[sc]e mit
60 | opensource org | opensource org licenses mit(?: licen[sc]e)?
[mit-0]
97 | spdx | spdx licen[sc]e identifier mit 0
80 | no attribution | mit no attribution(?: licen[sc]e)?
[apache]
95 | apache | licensed under the apache licen[sc]e version 2 0(?: the license)?
95 | apache | licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements
92 | apache | apache licen[sc]e version 2 0 january 2004
88 | apache | (?:released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?apache (?:software )?licen[sc]e
85 | compliance with the license | you may not use this file except in compliance with the license
85 | agreed to in writing | unless required by applicable law or agreed to in writing software distributed under the license
80 | apache | apache (?:software )?licen[sc]e (?:version |v )?[12](?: [01])?
78 | apache | apache software licen[sc]e
75 | www apache org | www apache org licenses(?: licen[sc]e 2 0)?
70 | apache 2 | apache 2(?: 0)? licen[sc]e
65 | asl 2 | asl 2 0
99 | spdx | spdx licen[sc]e identifier apache [12] [01]
97 | llvm exception | apache (?:licen[sc]e )?(?:v2 0|2 0) with llvm exceptions?
60 | licen | licen[sc]e apache(?: 2(?: 0)?)?
[gpl]
95 | free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e
94 | free software | is free software you can redistribute it and or modify
92 | general public | under the terms of the gnu general public licen[sc]e as published by the free software foundation
90 | general public | you should have received a copy of the gnu general public licen[sc]e
88 | general public | (?:released|licensed|distributed|available|published|provided|covered|governed) (?:under|by) (?:the )?(?:terms of (?:the )?)?(?:gnu )?general public licen[sc]e
85 | general public | (?:gnu )?general public licen[sc]e (?:version |v )?[123](?: 0)?(?: only| or (?:any )?later(?: version)?)?
80 | general public | see the gnu general public licen[sc]e for more details
78 | general public | gnu general public licen[sc]e
76 | fitness for a particular | without even the implied warranty of merchantability or fitness for a particular purpose
75 | gpl | gnu gpl(?: v?[23](?: 0)?)?
72 | gpl | licensed under (?:the )?gpl(?: ?v?[23](?: 0)?)?
70 | gpl | gpl ?v[23](?: 0)?(?: only| or later)?
70 | gpl | gpl(?: version)? [23](?: 0)?
65 | www gnu org | www gnu org (?:licenses|copyleft) gpl(?: 3 0)?(?: html| txt)?
99 | spdx | spdx licen[sc]e identifier gpl [123] 0(?: only| or later)?
90 | classpath exception | (?:gnu )?classpath exception
90 | linking exception | (?:gpl )?linking exception
88 | runtime library exception | gcc runtime library exception
85 | autoconf exception | autoconf (?:configure script )?exception
85 | bison exception | bison (?:parser )?exception
85 | font exception | gpl font exception
[lgpl]
96 | lesser general public | under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation
96 | library general public | under the terms of the gnu library general public licen[sc]e as published by the free software foundation
92 | general public | you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e
90 | general public | (?:gnu )?(?:lesser|library) general public licen[sc]e(?: (?:version |v )?[23](?: [01])?)?
80 | lgpl | (?:gnu )?lgpl ?v?[23](?: [01])?(?: only| or later)?
78 | lgpl | licensed under (?:the )?lgpl
65 | www gnu org | www gnu org licenses lgpl(?: [23] [01])?
99 | spdx | spdx licen[sc]e identifier lgpl [23] [01](?: only| or later)?
[agpl]
96 | affero | under the terms of the gnu affero general public licen[sc]e as published
92 | affero | you should have received a copy of the gnu affero general public licen[sc]e
90 | affero | (?:gnu )?affero general public licen[sc]e(?: (?:version |v )?[13](?: 0)?)?
80 | agpl | (?:gnu )?agpl ?v?3(?: 0)?(?: only| or later)?
65 | www gnu org | www gnu org licenses agpl(?: 3 0)?
99 | spdx | spdx licen[sc]e identifier agpl [13] 0(?: only| or later)?
[fdl]
95 | free documentation | under the terms of the gnu free documentation licen[sc]e version 1 [123]
85 | free documentation | (?:gnu )?free documentation licen[sc]e
75 | invariant sections | with no invariant sections(?: no front cover texts)?
75 | gfdl | gfdl(?: v?1 [123])?
99 | spdx | spdx licen[sc]e identifier gfdl 1 [123](?: only| or later)?
[bsd]
95 | source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
92 | redistributions of source | redistributions of source code must retain the above copyright notice this list of conditions
92 | redistributions in binary | redistributions in binary form must reproduce the above copyright notice
90 | neither the name | neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote
88 | advertising materials | all advertising materials mentioning features or use of this software must display
86 | copyright holders and contributors | this software is provided by the copyright holders and contributors as is
85 | bsd | (?:released|licensed|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?(?:new |modified |simplified |revised )?bsd (?:style )?licen[sc]e
80 | bsd | (?:new |modified |simplified |revised |original )bsd licen[sc]e
80 | bsd | bsd [234] clause(?: licen[sc]e)?
80 | bsd | (?:two|three|four|[234]) clause bsd(?: licen[sc]e)?
75 | bsd | bsd style licen[sc]e
72 | bsd | bsd licen[sc]e
99 | spdx | spdx licen[sc]e identifier bsd [0-4] clause(?: patent| clear)?
85 | freebsd | freebsd (?:documentation )?licen[sc]e
[0bsd]
97 | 0bsd | (?:spdx licen[sc]e identifier )?0bsd
80 | zero clause | (?:bsd )?zero clause bsd(?: licen[sc]e)?
[isc]
95 | permission to use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
88 | author disclaims | the software is provided as is and the author disclaims all warranties
80 | isc licen | (?:the )?isc licen[sc]e(?: isc)?
99 | spdx | spdx licen[sc]e identifier isc
[mpl]
95 | mozilla public | this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
92 | mozilla public | subject to the mozilla public licen[sc]e version 1 1
88 | mozilla public | if a copy of the mpl was not distributed with this file
80 | mozilla public | mozilla public licen[sc]e(?: (?:version |v )?[12](?: [01])?)?
75 | mpl 2 | mpl 2 0
65 | mozilla org mpl | (?:www )?mozilla org mpl(?: 2 0)?
99 | spdx | spdx licen[sc]e identifier mpl [12] [01](?: no copyleft exception)?
[epl]
92 | eclipse public | made available under the terms of the eclipse public licen[sc]e
80 | eclipse public | eclipse public licen[sc]e(?: (?:version |v )?[12](?: 0)?)?
85 | eclipse distribution | eclipse distribution licen[sc]e(?: v 1 0)?
75 | epl 2 | epl 2 0
75 | epl v1 | epl v1 0
99 | spdx | spdx licen[sc]e identifier epl [12] 0
[eupl]
90 | european union public | licensed under the eupl|european union public licen[sc]e(?: (?:version |v )?1 [012])?
75 | eupl | eupl(?: v?1 [012])?
99 | spdx | spdx licen[sc]e identifier eupl 1 [012]
[cddl]
92 | common development | subject to the terms of the common development and distribution licen[sc]e
80 | common development | common development and distribution licen[sc]e(?: (?:version |v )?1 [01])?
75 | cddl | cddl(?: (?:version |v )?1 [01])?
99 | spdx | spdx licen[sc]e identifier cddl 1 [01]
[cpl]
80 | common public | common public licen[sc]e(?: (?:version |v )?1 0)?
80 | common public attribution | common public attribution licen[sc]e(?: (?:version |v )?1 0)?
99 | spdx | spdx licen[sc]e identifier cpl 1 0
[zlib]
94 | held liable for any damages | in no event will the authors be held liable for any damages arising from the use of this software
90 | express or implied warranty | this software is provided as is without any express or implied warranty
88 | must not be misrepresented | the origin of this software must not be misrepresented
88 | altered source versions | altered source versions must be plainly marked as such
80 | zlib | (?:the )?zlib(?: libpng)? licen[sc]e
99 | spdx | spdx licen[sc]e identifier zlib
[libpng]
80 | libpng licen | (?:the )?(?:png reference library|libpng) licen[sc]e(?: version 2)?
99 | spdx | spdx licen[sc]e identifier libpng(?: 2 0)?
[boost]
95 | hereby granted | permission is hereby granted free of charge to any person or organization obtaining a copy
92 | boost software | distributed under the boost software licen[sc]e version 1 0
80 | boost software | boost software licen[sc]e(?: (?:version |v )?1 0)?
75 | boost org | (?:www )?boost org licen[sc]e 1 0 txt
99 | spdx | spdx licen[sc]e identifier bsl 1 0
[artistic]
92 | artistic licen | under the same terms as perl itself|under the (?:terms of the )?artistic licen[sc]e
80 | artistic licen | (?:the )?(?:clarified )?artistic licen[sc]e(?: (?:version )?[12](?: 0)?)?
85 | perl itself | under the same terms as perl itself
99 | spdx | spdx licen[sc]e identifier artistic [12] 0(?: perl)?
[psf]
90 | python software foundation | python software foundation licen[sc]e(?: version 2)?
85 | psf license | psf license agreement(?: for python [0-9 ]+)?
99 | spdx | spdx licen[sc]e identifier (?:psf 2 0|python 2 0)
[openssl]
92 | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
80 | openssl licen | (?:the )?(?:dual )?openssl (?:and ssleay )?licen[sc]e
85 | eric young | this product includes cryptographic software written by eric young
99 | spdx | spdx licen[sc]e identifier openssl
[ofl]
92 | open font | this font software is licensed under the sil open font licen[sc]e version 1 [01]
80 | open font | (?:sil )?open font licen[sc]e(?: (?:version )?1 [01])?
85 | reserved font name | with reserved font names?
99 | spdx | spdx licen[sc]e identifier ofl 1 [01](?: rfn| no rfn)?
[odbl]
90 | open database | made available under the open database licen[sc]e
80 | open database | open database licen[sc]e(?: (?:version |v )?1 0)?
75 | odbl | odbl(?: 1 0)?
[odc-by]
80 | open data commons attribution | open data commons attribution licen[sc]e(?: v1 0)?
[pddl]
80 | public domain dedication and license | (?:open data commons )?public domain dedication and licen[sc]e(?: pddl)?
[cc0]
92 | cc0 | cc0 1 0 universal(?: public domain dedication)?
85 | publicdomain zero | creativecommons org publicdomain zero 1 0
80 | cc0 | (?:licensed|released|dedicated) (?:under|to|with) (?:the )?(?:creative commons )?cc0
75 | creative commons zero | creative commons zero(?: v1 0)?(?: universal)?
70 | cc0 | cc0(?: 1 0)?
99 | spdx | spdx licen[sc]e identifier cc0 1 0
[cc-by-nc]
92 | attribution noncommercial | creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)?
90 | licenses by nc | creativecommons org licenses by nc [1234] [05]
80 | cc by nc | cc by nc(?: [1234] [05])?
99 | spdx | spdx licen[sc]e identifier cc by nc [1234] [05]
[cc-by-nc-sa]
95 | commercial sharealike | creative commons attribution non ?commercial sharealike(?: [1234] [05])?
92 | licenses by nc sa | creativecommons org licenses by nc sa [1234] [05]
85 | cc by nc sa | cc by nc sa(?: [1234] [05])?
[cc-by-nc-nd]
95 | commercial noderiv | creative commons attribution non ?commercial noderiv(?:s|atives)(?: [1234] [05])?
92 | licenses by nc nd | creativecommons org licenses by nc nd [1234] [05]
85 | cc by nc nd | cc by nc nd(?: [1234] [05])?
[cc-by-nd]
92 | attribution noderiv | creative commons attribution noderiv(?:s|atives)(?: [1234] [05])?
90 | licenses by nd | creativecommons org licenses by nd [1234] [05]
80 | cc by nd | cc by nd(?: [1234] [05])?
[cc-by-sa]
92 | creative commons | creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?
90 | licenses by sa | creativecommons org licenses by sa [1234] [05]
80 | cc by sa | cc by sa(?: [1234] [05])?
99 | spdx | spdx licen[sc]e identifier cc by sa [1234] [05]
[cc-by]
85 | creative commons | (?:licensed under (?:a |the )?)?creative commons attribution(?: (?:licen[sc]e|[1234] [05]))?(?: international| unported| generic)?
82 | licenses by | creativecommons org licenses by [1234] [05]
75 | cc by | cc by(?: [1234] [05])
60 | creative commons | (?:a |the )?creative commons licen[sc]e
99 | spdx | spdx licen[sc]e identifier cc by [1234] [05]
[unlicense]
95 | unencumbered | this is free and unencumbered software released into the public domain
80 | unlicense | (?:the )?unlicense(?: org)?
99 | spdx | spdx licen[sc]e identifier unlicense
[wtfpl]
90 | you want to public | do what the fuck you want to public licen[sc]e
80 | wtfpl | wtfpl(?: v?2)?
99 | spdx | spdx licen[sc]e identifier wtfpl
[public-domain]
88 | public domain | (?:hereby )?(?:released|placed|dedicated|put) (?:in|into|to) the public domain
75 | public domain | (?:this (?:work|file|code|software) )is in the public domain
70 | public domain | public domain dedication
85 | public domain mark | public domain mark(?: 1 0)?
[upl]
90 | universal permissive | (?:the )?universal permissive licen[sc]e(?: upl)?(?: (?:version |v )?1 0)?
99 | spdx | spdx licen[sc]e identifier upl 1 0
[ms-pl]
85 | microsoft public | microsoft public licen[sc]e(?: ms pl)?
75 | ms pl | ms pl
[ms-rl]
85 | microsoft reciprocal | microsoft reciprocal licen[sc]e(?: ms rl)?
75 | ms rl | ms rl
[osl]
85 | open software license | (?:licensed under the )?open software licen[sc]e(?: (?:version |v )?[123] [01])?
99 | spdx | spdx licen[sc]e identifier osl [123] [01]
[afl]
85 | academic free | (?:licensed under the )?academic free licen[sc]e(?: (?:version |v )?[123] [012])?
[ecl]
85 | educational community | educational community licen[sc]e(?: (?:version |v )?[12] 0)?
[ncsa]
85 | university of illinois | university of illinois(?: ncsa)? open source licen[sc]e
80 | ncsa | ncsa(?: open source)? licen[sc]e
[postgresql]
85 | postgresql licen | (?:the )?postgresql licen[sc]e
80 | without a written agreement | without fee and without a written agreement is hereby granted
[php]
85 | php licen | (?:the )?php licen[sc]e(?: (?:version |v )?[23] [0-9]+)?
80 | www php net license | www php net licen[sc]e [23] 0(?: [0-9]+)?(?: txt)?
[ruby]
85 | ruby licen | (?:the )?ruby licen[sc]e
80 | same terms as ruby | under the same terms as ruby
[vim]
85 | vim licen | (?:the )?vim licen[sc]e
[tcl]
85 | tcl tk licen | tcl tk licen[sc]e(?: terms)?
[curl]
85 | curl licen | (?:the )?curl licen[sc]e
[ijg]
85 | independent jpeg | based in part on the work of the independent jpeg group
[unicode]
85 | unicode data files | unicode data files and software
80 | unicode licen | unicode (?:inc )?licen[sc]e(?: agreement)?
[w3c]
85 | w3c software | w3c software (?:notice and|and document) licen[sc]e
[bouncy-castle]
80 | bouncy castle licen | bouncy castle licen[sc]e
[json]
90 | shall be used for good | the software shall be used for good not evil
[beerware]
90 | buy me a beer | you can buy me a beer in return
85 | beer ware | (?:the )?beer ware licen[sc]e
85 | beerware | (?:the )?beerware licen[sc]e
[sspl]
90 | server side public | server side public licen[sc]e(?: (?:version |v )?1)?
75 | sspl | sspl(?: ?v?1)?
[busl]
90 | business source | business source licen[sc]e(?: (?:version )?1 1)?
80 | change date | change date .{1,60}? change licen[sc]e
99 | spdx | spdx licen[sc]e identifier busl 1 1
[elastic]
90 | elastic licen | elastic licen[sc]e(?: (?:version |v )?2(?: 0)?)?
[commons-clause]
92 | commons clause | (?:the )?commons clause(?: licen[sc]e)?(?: condition)?(?: v1 0)?
[polyform]
88 | polyform | polyform (?:noncommercial|small business|shield|strict|perimeter|free trial) licen[sc]e(?: 1 0 0)?
[cecill]
85 | cecill | (?:under the )?cecill(?: [abc])?(?: (?:version |v )?[12](?: [01])?)?(?: licen[sc]e)?
[mulan]
85 | mulan | mulan (?:psl|publ|permissive software licen[sc]e)(?: ?v?[12])?
[hippocratic]
85 | hippocratic | hippocratic licen[sc]e(?: [0-9 ]+)?
[bigscience-rail]
88 | rail | (?:bigscience |creativeml )?open rail(?: m)?(?: licen[sc]e)?
85 | responsible ai | responsible ai licen[sc]e
[llama]
88 | llama | llama [23](?: [0-9])? community licen[sc]e(?: agreement)?
[proprietary]
85 | confidential and proprietary | confidential and proprietary(?: information)?
82 | proprietary | proprietary (?:software )?licen[sc]e
80 | end user license | end user licen[sc]e agreement
78 | eula | eula
76 | without the prior written | without the (?:express )?prior written (?:permission|consent) of
75 | unauthorized copying | unauthorized copying of this file(?: via any medium)?
75 | trade secret | (?:contains|constitutes) (?:valuable )?trade secrets?
60 | all rights reserved | all rights reserved
[dual]
70 | dual licensed | dual licensed under
70 | multi licensed | multi licensed under
68 | at your option | at your option any later version
65 | tri license | (?:mpl gpl lgpl )?tri licen[sc]e
[contributor-agreement]
75 | contributor license agreement | contributor licen[sc]e agreement
70 | certificate of origin | developer certificate of origin
[patent-grant]
75 | patent license | (?:perpetual )?(?:worldwide )?(?:non exclusive )?(?:no charge )?(?:royalty free )?(?:irrevocable )?patent licen[sc]e
75 | patent grant | additional (?:ip|patent) (?:rights )?grant|patents? grant
"""

#: What stands before and after a signature: it is made of whole words.
WHOLE = r"(?<![^ ])(?:{})(?![^ ])"


@dataclass(frozen=True)
class Signature:
    label: str
    pattern: str
    keyword: str
    priority: int
    base: bool = False


def signatures(rules: str = RULES) -> list[Signature]:
    """Every rule, highest priority first; ties by label and pattern. Base phrases have priority 50."""
    out, label = [Signature(v, WHOLE.format(k), k, 50, True) for k, v in BASE.items()], ""
    for line in rules.strip().splitlines():
        if line.startswith("["):
            label = line.strip("[]")
        else:
            priority, keyword, pattern = line.split(" | ", 2)
            out.append(Signature(label, WHOLE.format(pattern), keyword, int(priority)))
    return sorted(out, key=lambda s: (-s.priority, s.label, s.pattern))
