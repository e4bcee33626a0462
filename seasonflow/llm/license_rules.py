"""Signatures of licences, written by hand.

A line is: level, label, keyword, pattern. Patterns are matched on a text's lower-case words with one blank
between them, from word to word, so a version 2.0 reads ``2 0``. Level 1 are tags and notices, 2 names with a
version, 3 plain names, 4 hints. Every text that a pattern matches holds its keyword as a word.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    level: int
    label: str
    keyword: str
    pattern: str


#: The phrases and labels that are always reported.
BASE = (
    Rule(3, "gpl", "gnu", "gnu general public license"),
    Rule(3, "apache", "apache", "apache license"),
    Rule(3, "cc-by", "cc", "cc by"),
    Rule(3, "mit", "license", "mit license"),
)

TEXT = """
1|gpl-1.0-or-later|gnu|gnu general public licen[cs]e as published by the free software foundation either version 1(?: 0)?(?: of the licen[cs]e)? or at your option any later version
1|gpl-2.0-only|gnu|gnu general public licen[cs]e(?: as published by the free software foundation)? version 2(?: 0)? only
1|gpl-2.0-or-later|gnu|gnu general public licen[cs]e as published by the free software foundation either version 2(?: 0)?(?: of the licen[cs]e)? or at your option any later version
1|gpl-3.0-only|gnu|gnu general public licen[cs]e(?: as published by the free software foundation)? version 3(?: 0)? only
1|gpl-3.0-or-later|gnu|gnu general public licen[cs]e as published by the free software foundation either version 3(?: 0)?(?: of the licen[cs]e)? or at your option any later version
1|gpl-1.0|spdx|spdx license identifier gpl 1 0(?: only| or later)?
1|gpl-2.0-only|spdx|spdx license identifier gpl 2 0(?: only)?
1|gpl-2.0-or-later|spdx|spdx license identifier gpl 2 0 or later
1|gpl-3.0-only|spdx|spdx license identifier gpl 3 0(?: only)?
1|gpl-3.0-or-later|spdx|spdx license identifier gpl 3 0 or later
2|gpl-1.0|gnu|gnu general public licen[cs]e(?: gpl)?(?: version)? (?:v1|1)(?: 0)?
2|gpl-2.0|gnu|gnu general public licen[cs]e(?: gpl)?(?: version)? (?:v2|2)(?: 0)?
2|gpl-3.0|gnu|gnu general public licen[cs]e(?: gpl)?(?: version)? (?:v3|3)(?: 0)?
2|gpl-2.0|gpl|(?:gnu )?gpl(?: version)? (?:v2|2)(?: 0)?
2|gpl-3.0|gpl|(?:gnu )?gpl(?: version)? (?:v3|3)(?: 0)?
2|gpl-2.0|gplv2|(?:gnu )?gplv2(?: 0)?
2|gpl-3.0|gplv3|(?:gnu )?gplv3(?: 0)?
2|gpl-2.0-or-later|gplv2|gplv2 or later
2|gpl-3.0-or-later|gplv3|gplv3 or later
3|gpl|gnu|gnu general public licence
3|gpl|gpl|gnu gpl
3|gpl|gpl|gpl licen[cs]ed?
3|gpl|gpl|(?:under|of) the gpl
3|gpl-exception|classpath|classpath exception
3|gpl-exception|gpl|gpl linking exception
2|gpl-exception|gcc|gcc runtime library exception
1|lgpl-2.0-or-later|gnu|gnu library general public licen[cs]e as published by the free software foundation either version 2(?: 0)?(?: of the licen[cs]e)? or at your option any later version
1|lgpl-2.1-or-later|gnu|gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1(?: of the licen[cs]e)? or at your option any later version
1|lgpl-3.0-or-later|gnu|gnu lesser general public licen[cs]e as published by the free software foundation either version 3(?: 0)?(?: of the licen[cs]e)? or at your option any later version
1|lgpl-2.0|spdx|spdx license identifier lgpl 2 0(?: only| or later)?
1|lgpl-2.1|spdx|spdx license identifier lgpl 2 1(?: only| or later)?
1|lgpl-3.0|spdx|spdx license identifier lgpl 3 0(?: only| or later)?
2|lgpl-2.0|gnu|gnu library general public licen[cs]e(?: version)? (?:v2|2)(?: 0)?
2|lgpl-2.1|gnu|gnu lesser general public licen[cs]e(?: lgpl)?(?: version)? (?:v2|2) 1
2|lgpl-3.0|gnu|gnu lesser general public licen[cs]e(?: lgpl)?(?: version)? (?:v3|3)(?: 0)?
2|lgpl-2.1|lgpl|lgpl(?: version)? (?:v2|2) 1
2|lgpl-3.0|lgpl|lgpl(?: version)? (?:v3|3)(?: 0)?
2|lgpl-2.1|lgplv2|lgplv2 1
2|lgpl-3.0|lgplv3|lgplv3
3|lgpl|gnu|gnu (?:lesser|library) general public licen[cs]e
3|lgpl|lgpl|lgpl
1|agpl-3.0-or-later|gnu|gnu affero general public licen[cs]e as published by the free software foundation either version 3(?: 0)?(?: of the licen[cs]e)? or at your option any later version
1|agpl-3.0|spdx|spdx license identifier agpl 3 0(?: only| or later)?
1|agpl-1.0|spdx|spdx license identifier agpl 1 0(?: only| or later)?
2|agpl-3.0|affero|(?:gnu )?affero general public licen[cs]e(?: agpl)?(?: version)? (?:v3|3)(?: 0)?
2|agpl-1.0|affero|affero general public licen[cs]e(?: version)? (?:v1|1)(?: 0)?
2|agpl-3.0|agpl|agpl(?: version)? (?:v3|3)(?: 0)?
2|agpl-3.0|agplv3|agplv3
3|agpl|affero|(?:gnu )?affero general public licen[cs]e
3|agpl|agpl|agpl
2|gfdl-1.1|gnu|gnu free documentation licen[cs]e version 1 1
2|gfdl-1.2|gnu|gnu free documentation licen[cs]e version 1 2
2|gfdl-1.3|gnu|gnu free documentation licen[cs]e version 1 3
3|gfdl|gnu|gnu free documentation licen[cs]e
3|gfdl|gfdl|gfdl
1|apache-2.0|apache|licensed under the apache licen[cs]e version 2 0(?: the license)?
1|apache-2.0|spdx|spdx license identifier apache 2 0
1|apache-1.1|spdx|spdx license identifier apache 1 [01]
1|apache-2.0|apache|(?:http|https) www apache org licenses license 2 0(?: txt| html)?
2|apache-2.0|apache|apache(?: software)? licen[cs]e(?: version)? (?:v2|2)(?: 0)?
2|apache-2.0|apache|apache (?:v2|2 0)(?: licen[cs]ed?)?
2|apache-1.1|apache|apache(?: software)? licen[cs]e(?: version)? (?:v1|1) 1
2|apache-1.0|apache|apache(?: software)? licen[cs]e(?: version)? (?:v1|1) 0
3|apache|apache|apache (?:software |public )?licence
3|apache|apache|apache software license
3|apache|apache|apache licensed
1|mit|permission|permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
1|mit|spdx|spdx license identifier mit
1|mit-0|spdx|spdx license identifier mit 0
1|mit|opensource|(?:http|https)(?: www)? opensource org licenses mit(?: license)?(?: php)?
2|mit|expat|expat(?: mit)? licen[cs]e
2|mit-0|mit|mit no attribution(?: licen[cs]e)?
3|mit|licence|mit licence
3|mit|licensed|mit licensed
3|mit|licensed|licensed under(?: the)? mit
3|mit|released|released under(?: the)? mit
3|mit|mit|mit x11(?: licen[cs]e)?
3|mit|license|license mit
2|x11|x11|x11 licen[cs]e
1|isc|permission|permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
1|isc|spdx|spdx license identifier isc
2|isc|isc|isc licen[cs]e
3|isc|isc|licensed under(?: the)? isc
1|bsd-2-clause|spdx|spdx license identifier bsd 2 clause
1|bsd-3-clause|spdx|spdx license identifier bsd 3 clause
1|bsd-4-clause|spdx|spdx license identifier bsd 4 clause
1|0bsd|spdx|spdx license identifier 0bsd
1|bsd|redistribution|redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
1|bsd-3-clause|endorse|(?:name|names) of(?: the)?(?: [^ ]+){1,6} (?:nor the names of its contributors )?may be used to endorse or promote products derived from this software
1|bsd-4-clause|acknowledgement|all advertising materials mentioning features or use of this software must display the following acknowledgement
2|bsd-2-clause|bsd|(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd bsd)(?: licen[cs]e)?
2|bsd-3-clause|bsd|(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?
2|bsd-4-clause|bsd|(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)(?: licen[cs]e)?
2|bsd-2-clause|freebsd|freebsd licen[cs]e
2|0bsd|0bsd|0bsd(?: licen[cs]e)?
2|0bsd|bsd|zero clause bsd(?: licen[cs]e)?
3|bsd|bsd|bsd(?: style)? licen[cs]ed?
3|bsd|bsd|berkeley software distribution bsd
1|mpl-2.0|mozilla|subject to the terms of the mozilla public licen[cs]e v 2 0
1|mpl-1.1|mozilla|subject to the mozilla public licen[cs]e version 1 1
1|mpl-2.0|spdx|spdx license identifier mpl 2 0
1|mpl-1.1|spdx|spdx license identifier mpl 1 [01]
2|mpl-2.0|mozilla|mozilla public licen[cs]e(?: mpl)?(?: version| v)? 2 0
2|mpl-1.1|mozilla|mozilla public licen[cs]e(?: mpl)?(?: version| v)? 1 1
2|mpl-1.0|mozilla|mozilla public licen[cs]e(?: mpl)?(?: version| v)? 1 0
2|mpl-2.0|mpl|mpl(?: version| v)? 2 0
2|mpl-1.1|mpl|mpl(?: version| v)? 1 1
3|mpl|mozilla|mozilla public licen[cs]e
1|epl-2.0|spdx|spdx license identifier epl 2 0
1|epl-1.0|spdx|spdx license identifier epl 1 0
1|epl-1.0|eclipse|made available under the terms of the eclipse public licen[cs]e v(?: )?1 0
2|epl-2.0|eclipse|eclipse public licen[cs]e(?: epl)?(?: version| v)? 2 0
2|epl-1.0|eclipse|eclipse public licen[cs]e(?: epl)?(?: version| v)? 1 0
3|epl|eclipse|eclipse public licen[cs]e
2|edl-1.0|eclipse|eclipse distribution licen[cs]e(?: version| v)?(?: 1 0)?
1|cddl-1.0|spdx|spdx license identifier cddl 1 0
1|cddl-1.1|spdx|spdx license identifier cddl 1 1
2|cddl-1.0|cddl|cddl(?: version| v)? 1 0
2|cddl-1.1|cddl|cddl(?: version| v)? 1 1
3|cddl|common|common development and distribution licen[cs]e(?: cddl)?
2|cpl-1.0|common|common public licen[cs]e(?: version| v)? 1 0
3|cpl|common|common public licen[cs]e
2|cpal-1.0|common|common public attribution licen[cs]e(?: version| v)?(?: 1 0)?
1|eupl-1.2|spdx|spdx license identifier eupl 1 [012]
2|eupl-1.1|eupl|eupl(?: version| v)? 1 1
2|eupl-1.2|eupl|eupl(?: version| v)? 1 2
3|eupl|european|european union public licen[cs]e
2|cecill-2.1|cecill|cecill(?: version| v)? 2 1
2|cecill-b|cecill|cecill b
2|cecill-c|cecill|cecill c
3|cecill|cecill|cecill(?: free software)? licen[cs]e
2|artistic-1.0|artistic|artistic licen[cs]e(?: version| v)? 1 0
2|artistic-2.0|artistic|artistic licen[cs]e(?: version| v)? 2 0
3|artistic|artistic|artistic licen[cs]e
2|artistic-or-gpl|perl|under the same terms as perl(?: itself)?
2|psf-2.0|python|python software foundation licen[cs]e(?: version 2)?
3|python|python|python licen[cs]e
3|ruby|ruby|ruby licen[cs]e
2|php-3.01|php|php licen[cs]e(?: version| v)? 3 01
2|php-3.0|php|php licen[cs]e(?: version| v)? 3 0
3|php|php|php licen[cs]e
1|zlib|misrepresented|origin of this software must not be misrepresented
1|zlib|spdx|spdx license identifier zlib
2|zlib|zlib|zlib(?: libpng)? licen[cs]e
2|libpng|libpng|libpng licen[cs]e
2|openssl|openssl|openssl(?: ssleay)? licen[cs]e
1|openssl|openssl|this product includes software developed by the openssl project
1|bsl-1.0|boost|distributed under the boost software licen[cs]e version 1 0
1|bsl-1.0|spdx|spdx license identifier bsl 1 0
2|bsl-1.0|boost|boost software licen[cs]e(?: version 1 0)?
1|unlicense|unencumbered|this is free and unencumbered software released into the public domain
1|unlicense|spdx|spdx license identifier unlicense
3|unlicense|unlicense|(?:the )?unlicense
2|wtfpl|wtfpl|wtfpl(?: licen[cs]e)?(?: version 2| 2)?
1|cc0-1.0|spdx|spdx license identifier cc0 1 0
1|cc0-1.0|publicdomain|(?:http|https) creativecommons org publicdomain zero 1 0
2|cc0-1.0|cc0|cc0(?: 1 0)?(?: universal)?
2|cc0-1.0|creative|creative commons (?:zero|0)(?: v1)?(?: 1 0)?(?: universal)?
1|cc-by-4.0|spdx|spdx license identifier cc by [1234] 0
1|cc-by-sa-4.0|spdx|spdx license identifier cc by sa [1234] 0
1|cc-by|creativecommons|(?:http|https) creativecommons org licenses by [1234] [05]
1|cc-by-sa|creativecommons|(?:http|https) creativecommons org licenses by sa [1234] [05]
1|cc-by-nd|creativecommons|(?:http|https) creativecommons org licenses by nd [1234] [05]
1|cc-by-nc|creativecommons|(?:http|https) creativecommons org licenses by nc [1234] [05]
1|cc-by-nc-sa|creativecommons|(?:http|https) creativecommons org licenses by nc sa [1234] [05]
1|cc-by-nc-nd|creativecommons|(?:http|https) creativecommons org licenses by nc nd [1234] [05]
2|cc-by-1.0|cc|cc by 1 0
2|cc-by-2.0|cc|cc by 2 0
2|cc-by-2.5|cc|cc by 2 5
2|cc-by-3.0|cc|cc by 3 0
2|cc-by-4.0|cc|cc by 4 0
2|cc-by-sa-2.0|cc|cc by sa 2 0
2|cc-by-sa-3.0|cc|cc by sa 3 0
2|cc-by-sa-4.0|cc|cc by sa 4 0
2|cc-by-nd-3.0|cc|cc by nd 3 0
2|cc-by-nd-4.0|cc|cc by nd 4 0
2|cc-by-nc-3.0|cc|cc by nc 3 0
2|cc-by-nc-4.0|cc|cc by nc 4 0
2|cc-by-nc-sa-3.0|cc|cc by nc sa 3 0
2|cc-by-nc-sa-4.0|cc|cc by nc sa 4 0
2|cc-by-nc-nd-3.0|cc|cc by nc nd 3 0
2|cc-by-nc-nd-4.0|cc|cc by nc nd 4 0
3|cc-by-sa|cc|cc by sa
3|cc-by-nd|cc|cc by nd
3|cc-by-nc|cc|cc by nc
3|cc-by-nc-sa|cc|cc by nc sa
3|cc-by-nc-nd|cc|cc by nc nd
2|cc-by-4.0|creative|creative commons attribution 4 0(?: international)?(?: licen[cs]e)?
2|cc-by-3.0|creative|creative commons attribution 3 0(?: unported)?(?: licen[cs]e)?
2|cc-by-sa-4.0|creative|creative commons attribution share ?alike 4 0(?: international)?(?: licen[cs]e)?
2|cc-by-sa-3.0|creative|creative commons attribution share ?alike 3 0(?: unported)?(?: licen[cs]e)?
2|cc-by-nc-4.0|creative|creative commons attribution non ?commercial 4 0(?: international)?(?: licen[cs]e)?
2|cc-by-nc-sa-4.0|creative|creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[cs]e)?
2|cc-by-nc-nd-4.0|creative|creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[cs]e)?
3|cc-by|creative|creative commons attribution(?: licen[cs]e)?
3|cc-by-sa|creative|creative commons attribution share ?alike(?: licen[cs]e)?
3|cc-by-nc|creative|creative commons attribution non ?commercial(?: licen[cs]e)?
4|creative-commons|creative|creative commons(?: licen[cs]ed?)?
1|odbl-1.0|spdx|spdx license identifier odbl 1 0
2|odbl-1.0|odbl|odbl(?: version| v)? 1 0
3|odbl|database|open (?:data commons open )?database licen[cs]e(?: odbl)?
3|odbl|odbl|odbl
3|odc-by|commons|open data commons attribution licen[cs]e
3|pddl|dedication|open data commons public domain dedication and licen[cs]e
2|ofl-1.1|sil|sil open font licen[cs]e(?: ofl)?(?: version| v)?(?: 1 [01])?
3|ofl|font|open font licen[cs]e
1|ofl-1.1|spdx|spdx license identifier ofl 1 [01]
2|ms-pl|microsoft|microsoft public licen[cs]e(?: ms pl)?
2|ms-rl|microsoft|microsoft reciprocal licen[cs]e(?: ms rl)?
2|ncsa|ncsa|(?:university of illinois )?ncsa(?: open source)? licen[cs]e
3|w3c|w3c|w3c(?: software)?(?: notice and)? licen[cs]e
2|ipl-1.0|ibm|ibm public licen[cs]e(?: version| v)?(?: 1 0)?
2|qpl-1.0|qpl|qpl(?: version| v)? 1 0
3|qpl|public|q public licen[cs]e
3|sleepycat|sleepycat|sleepycat licen[cs]e
2|sissl|sun|sun industry standards source licen[cs]e
2|afl-3.0|academic|academic free licen[cs]e(?: version| v)? 3 0
3|afl|academic|academic free licen[cs]e
2|osl-3.0|open|open software licen[cs]e(?: version| v)? 3 0
2|upl-1.0|universal|universal permissive licen[cs]e(?: upl)?(?: version| v)?(?: 1 0)?
3|vim|vim|vim licen[cs]e
3|zend|zend|zend(?: engine)? licen[cs]e
2|zpl-2.1|zope|zope public licen[cs]e(?: zpl)?(?: version| v)? 2 1
3|zpl|zope|zope public licen[cs]e
3|beerware|beerware|beerware(?: licen[cs]e)?
1|beerware|beer|if we meet some day and you think this stuff is worth it you can buy me a beer
1|json|evil|the software shall be used for good not evil
3|icu|icu|icu licen[cs]e
3|unicode|unicode|unicode(?: inc)? licen[cs]e(?: agreement)?
3|curl|curl|curl licen[cs]e
2|ftl|freetype|freetype(?: project)? licen[cs]e
2|ijg|jpeg|this software is based in part on the work of the independent jpeg group
3|tcl|tcl|tcl tk licen[cs]e
2|postgresql|postgresql|postgresql licen[cs]e
2|hpnd|historical|historical permission notice and disclaimer
2|elastic-2.0|elastic|elastic licen[cs]e(?: version| v)? 2 0
3|elastic|elastic|elastic licen[cs]e
2|sspl-1.0|sspl|sspl(?: version| v)?(?: 1)?
3|sspl|server|server side public licen[cs]e
2|busl-1.1|busl|busl 1 1
3|busl|business|business source licen[cs]e(?: 1 1)?
3|commons-clause|clause|commons clause(?: licen[cs]e)?(?: condition)?
2|polyform-noncommercial-1.0.0|polyform|polyform noncommercial(?: licen[cs]e)?(?: 1 0 0)?
2|polyform-small-business-1.0.0|polyform|polyform small business(?: licen[cs]e)?(?: 1 0 0)?
3|blueoak-1.0.0|oak|blue oak model licen[cs]e
2|mulan-psl-2.0|mulan|mulan(?: permissive software licen[cs]e| psl)(?: version| v)? ?2
3|mulan-psl|mulan|mulan (?:permissive software licen[cs]e|psl)
2|openrail|openrail|(?:bigscience |creativeml )?openrail(?: m)?(?: licen[cs]e)?
3|rail|responsible|responsible ai licen[cs]e
4|public-domain|domain|(?:released into|dedicated to|placed in|in) the public domain
4|public-domain|domain|public domain
4|open-source|osi|osi approved(?: open source)?(?: licen[cs]e)?
4|free-software|libre|free libre(?: and)? open source software
4|dual-licence|dual|dual licen[cs]ed(?: under)?
4|warranty|warranty|without warranty of any kind(?: express or implied)?
4|warranty|warranty|without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
4|proprietary|proprietary|proprietary and confidential
4|proprietary|proprietary|proprietary (?:software )?licen[cs]e
4|proprietary|permission|no part of this (?:publication|work|document) may be reproduced(?: [^ ]+){0,12} without(?: [^ ]+){0,4} permission
4|proprietary|unauthorized|unauthorized (?:copying|reproduction|use)(?: [^ ]+){0,8} is strictly prohibited
4|all-rights-reserved|rights|all rights reserved
4|copyright|copyright|copyright(?: c| ©)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
4|eula|eula|end user licen[cs]e agreement eula
3|eula|user|end user licen[cs]e agreement
4|non-commercial|commercial|for non commercial use only
4|non-commercial|noncommercial|noncommercial use only
4|attribution|attribution|attribution required
4|licence-file|license|see(?: the)? (?:file )?license(?: file| txt| md)?(?: for(?: more)? (?:details|information|terms))?
4|licence-file|licensing|see(?: the)? copying(?: file)? for licensing(?: terms| details| information)?
"""


def rules(text: str = TEXT, base: tuple[Rule, ...] = BASE) -> list[Rule]:
    """The base phrases, then the signatures in their order."""
    lines = [line.split("|", 3) for line in text.strip().splitlines()]
    return [*base, *(Rule(int(level), label, keyword, pattern) for level, label, keyword, pattern in lines)]
