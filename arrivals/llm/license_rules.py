"""Signature rules of the license scan, in order of priority.

A line is a rule: rank, label, keyword, pattern. Texts are matched as words of digits, lower-case
letters and characters beyond ASCII, one blank apart, so `GPL-3.0+` reads `gpl 3 0`. A pattern covers whole
words and has no blank inside a character class other than `[^ ]`. Every match of a pattern holds the words
of its keyword, written with `_` for blanks, and with `*` where the last word may go on. Ranks: 1 wording of a license text or notice, 2 a license with its version, 3 a license
family or short name, 4 a hint. Rules in BASE are the phrases that every scan counts.
"""

from __future__ import annotations

from typing import NamedTuple

BASE = """
3 cc-by cc cc by
3 gpl general_public general public license
3 reserved reserved all rights reserved
"""

RULES = """
1 mit hereby_granted permission is hereby granted free of charge to any person obtaining a copy(?: of this software)?
1 mit merchantability the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
1 mit sublicense to use copy modify merge publish distribute sublicense and or sell copies
1 mit copyright the above copyright notice and this permission notice shall be included in all
1 isc hereby_granted permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
1 0bsd hereby_granted use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
1 hpnd documentation permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose
1 bsd redistribution redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?
1 bsd redistributions redistributions of source code must retain the above copyright notice(?: this list of conditions)?
1 bsd redistributions redistributions in binary form must reproduce the above copyright notice
1 bsd-3-clause endorse (?:neither the names? of|the names? of)(?: [^ ]+){1,12} may (?:not )?be used to endorse or promote products
1 bsd-4-clause advertising_materials all advertising materials mentioning features or use of this software must display
1 bsd software_is this software is provided by the (?:copyright holders?|authors?|regents|contributors)(?: and contributors)? as is
1 apache-2.0 apache licensed under the apache license version 2 0
1 apache-2.0 compliance you may not use this file except in compliance with the license
1 apache-2.0 apache you may obtain a copy of the license at(?: https?)? www apache org licenses license 2 0
1 apache-2.0 limitations see the license for the specific language governing permissions and limitations under the license
1 apache-2.0 unless_required unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
1 apache-1.1 apache this product includes software developed by the apache software foundation
1 gpl-3.0-or-later any_later either version 3 of the license or at your option any later version
1 gpl-2.0-or-later any_later either version 2 of the license or at your option any later version
1 gpl-1.0-or-later any_later either version 1 or at your option any later version
1 lgpl-2.1-or-later any_later either version 2 1 of the license or at your option any later version
1 lgpl-2.1-or-later lesser_general under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1
1 lgpl-3.0-or-later lesser_general under the terms of the gnu lesser general public license as published by the free software foundation either version 3
1 lgpl-2.0-or-later library_general under the terms of the gnu library general public license as published by the free software foundation either version 2
1 agpl-3.0-or-later affero under the terms of the gnu affero general public license as published by the free software foundation either version 3
1 gpl-3.0-or-later general_public under the terms of the gnu general public license as published by the free software foundation either version 3(?: of the license)? or
1 gpl-2.0-or-later general_public under the terms of the gnu general public license as published by the free software foundation either version 2(?: of the license)? or
1 gpl-2.0-only general_public under the terms of the gnu general public license version 2(?: only)? as published by
1 gpl-3.0-only general_public under the terms of the gnu general public license version 3(?: only)? as published by
1 gpl redistribute this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
1 gpl merchantability without even the implied warranty of merchantability or fitness for a particular purpose see the gnu(?: [^ ]+){0,2} general public license
1 gpl received_a you should have received a copy of the gnu general public license
1 lgpl received_a you should have received a copy of the gnu (?:lesser|library) general public license
1 agpl received_a you should have received a copy of the gnu affero general public license
1 gfdl modify_this permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
1 mpl-2.0 mozilla this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0
1 mpl-1.1 mozilla the contents of this file are subject to the mozilla public license version 1 1
1 mpl-1.0 mozilla the contents of this file are subject to the mozilla public license version 1 0
1 epl-2.0 eclipse this program and the accompanying materials are made available under the terms of the eclipse public license(?: v(?:ersion)?)? ?2 0
1 epl-1.0 eclipse this program and the accompanying materials are made available under the terms of the eclipse public license(?: v(?:ersion)?)? ?1 0
1 cddl-1.0 common_development the contents of this file are subject to the terms of the common development and distribution license
1 zlib misrepresented the origin of this software must not be misrepresented
1 zlib altered_source altered source versions must be plainly marked as such
1 boost-1.0 boost distributed under the boost software license version 1 0
1 unlicense unencumbered this is free and unencumbered software released into the public domain
1 wtfpl fuck you just do what the fuck you want to
1 beerware a_beer if we meet some day and you think this stuff is worth it you can buy me a beer
1 ofl-1.1 font_software this font software is licensed under the sil open font license version 1 1
1 psf-2.0 psf psf is making python available to licensee on an as is basis
1 openssl openssl this product includes software developed by the openssl project
1 ssleay cryptographic this product includes cryptographic software written by eric young
1 json good_not the software shall be used for good not evil
1 ncsa hereby_granted permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software
1 cc-by-4.0 attribution this work is licensed under (?:a|the) creative commons attribution 4 0 international
1 cc-by-sa-4.0 sharealike this work is licensed under (?:a|the) creative commons attribution sharealike 4 0 international
1 cc-by-nc-4.0 noncommercial this work is licensed under (?:a|the) creative commons attribution noncommercial 4 0 international
1 cc-by-nc-sa-4.0 sharealike this work is licensed under (?:a|the) creative commons attribution noncommercial sharealike 4 0 international
1 cc-by-nc-nd-4.0 noderivatives this work is licensed under (?:a|the) creative commons attribution noncommercial noderivatives 4 0 international
1 cc-by-nd-4.0 noderivatives this work is licensed under (?:a|the) creative commons attribution noderivatives 4 0 international
1 cc0-1.0 waived to the extent possible under law(?: [^ ]+){1,12} has waived all copyright
1 gpl-3.0 licensed licensed under the gnu general public license v(?:ersion)? ?3
1 gpl-2.0 licensed licensed under the gnu general public license v(?:ersion)? ?2
1 mit licen* (?:released|licensed|distributed|available) under the (?:terms of the )?(?:mit|expat) licen[cs]e
1 bsd licen* (?:released|licensed|distributed|available) under (?:the|a) (?:terms of the )?(?:new |modified |simplified )?bsd (?:style )?licen[cs]e
1 apache licen* (?:released|distributed|available) under the (?:terms of the )?apache licen[cs]e
1 proprietary confidential (?:this (?:document|file|software) (?:is|contains) )?(?:proprietary and confidential|confidential and proprietary)(?: information)?
1 proprietary unauthorized unauthorized (?:copying|reproduction|distribution|use) of this (?:file|document|work|software)
1 proprietary no_part no part of this (?:publication|book|work|document) may be reproduced
1 proprietary permission (?:may not be|not to be) (?:reproduced|copied|distributed|redistributed)(?: [^ ]+){0,8} without (?:the )?(?:prior |express |written ){0,3}permission
2 apache-2.0 apache apache (?:software )?licen[cs]e v(?:ersion)? ?2(?: 0)?
2 apache-2.0 apache apache (?:licen[cs]e )?2 0
2 apache-2.0 apache asl 2 0 apache
2 apache-1.1 apache apache (?:software )?licen[cs]e (?:version |v ?)?1 1
2 apache-1.0 apache apache (?:software )?licen[cs]e (?:version |v ?)?1 0
2 bsd-2-clause clause bsd (?:2|two) clause(?: licen[cs]e)?
2 bsd-2-clause clause (?:2|two) clause bsd(?: licen[cs]e)?
2 bsd-2-clause simplified simplified bsd(?: licen[cs]e)?
2 bsd-2-clause freebsd freebsd licen[cs]e
2 bsd-3-clause clause bsd (?:3|three) clause(?: licen[cs]e)?
2 bsd-3-clause clause (?:3|three) clause bsd(?: licen[cs]e)?
2 bsd-3-clause bsd (?:new|modified|revised) bsd(?: licen[cs]e)?
2 bsd-4-clause clause bsd (?:4|four) clause(?: licen[cs]e)?
2 bsd-4-clause bsd (?:old|original) bsd(?: licen[cs]e)?
2 0bsd bsd (?:0|zero) clause bsd(?: licen[cs]e)?
2 0bsd 0bsd 0bsd
2 gpl-1.0 gpl* (?:gnu )?gpl(?: licen[cs]e)?(?: v| version)? ?1 0
2 gpl-2.0 gpl* (?:gnu )?gpl(?: licen[cs]e)?(?: v| version)? ?2(?: 0)?(?: only)?
2 gpl-2.0-or-later gpl* (?:gnu )?gpl(?: v| version)? ?2(?: 0)? or (?:any )?later
2 gpl-3.0 gpl* (?:gnu )?gpl(?: licen[cs]e)?(?: v| version)? ?3(?: 0)?(?: only)?
2 gpl-3.0-or-later gpl* (?:gnu )?gpl(?: v| version)? ?3(?: 0)? or (?:any )?later
2 gpl-2.0 gplv2 (?:gnu )?gplv2
2 gpl-3.0 gplv3 (?:gnu )?gplv3
2 gpl-1.0 general_public (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)? v(?:ersion)? ?1(?: 0)?
2 gpl-2.0 general_public (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)? v(?:ersion)? ?2(?: 0)?
2 gpl-3.0 general_public (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)? v(?:ersion)? ?3(?: 0)?
2 lgpl-2.0 lgpl* (?:gnu )?lgpl(?: v| version)? ?2 0
2 lgpl-2.1 lgpl* (?:gnu )?lgpl(?: v| version)? ?2 1
2 lgpl-3.0 lgpl* (?:gnu )?lgpl(?: v| version)? ?3(?: 0)?
2 lgpl-2.1 lgplv2 (?:gnu )?lgplv2 1
2 lgpl-3.0 lgplv3 (?:gnu )?lgplv3
2 lgpl-2.1 lesser_general (?:gnu )?lesser general public licen[cs]e v(?:ersion)? ?2 1
2 lgpl-3.0 lesser_general (?:gnu )?lesser general public licen[cs]e v(?:ersion)? ?3(?: 0)?
2 lgpl-2.0 library_general (?:gnu )?library general public licen[cs]e v(?:ersion)? ?2(?: 0)?
2 agpl-3.0 agpl* (?:gnu )?agpl(?: v| version)? ?3(?: 0)?
2 agpl-3.0 agplv3 (?:gnu )?agplv3
2 agpl-3.0 affero (?:gnu )?affero general public licen[cs]e v(?:ersion)? ?3(?: 0)?
2 agpl-1.0 affero affero general public licen[cs]e v(?:ersion)? ?1(?: 0)?
2 gfdl-1.1 documentation (?:gnu )?free documentation licen[cs]e v(?:ersion)? ?1 1
2 gfdl-1.2 documentation (?:gnu )?free documentation licen[cs]e v(?:ersion)? ?1 2
2 gfdl-1.3 documentation (?:gnu )?free documentation licen[cs]e v(?:ersion)? ?1 3
2 mpl-1.0 mozilla mozilla public licen[cs]e(?: v(?:ersion)?)? ?1 0
2 mpl-1.1 mozilla mozilla public licen[cs]e(?: v(?:ersion)?)? ?1 1
2 mpl-2.0 mozilla mozilla public licen[cs]e(?: v(?:ersion)?)? ?2 0
2 mpl-1.1 mpl* mpl(?: v| version)? ?1 1
2 mpl-2.0 mpl* mpl(?: v| version)? ?2 0
2 epl-1.0 eclipse eclipse public licen[cs]e(?: v(?:ersion)?)? ?1 0
2 epl-2.0 eclipse eclipse public licen[cs]e(?: v(?:ersion)?)? ?2 0
2 epl-1.0 epl* epl(?: v| version)? ?1 0
2 epl-2.0 epl* epl(?: v| version)? ?2 0
2 cddl-1.0 cddl* cddl(?: v| version)? ?1 0
2 cddl-1.1 cddl* cddl(?: v| version)? ?1 1
2 cpl-1.0 common_public common public licen[cs]e(?: v| version)? ?1 0
2 eupl-1.1 eupl* eupl(?: v| version)? ?1 1
2 eupl-1.2 eupl* eupl(?: v| version)? ?1 2
2 cc0-1.0 cc0 cc0(?: 1 0)?(?: universal)?
2 cc0-1.0 commons_zero creative commons zero(?: v?1 0)?(?: universal)?
2 cc-by-1.0 attribution (?:creative commons|cc) attribution 1 0
2 cc-by-2.0 attribution (?:creative commons|cc) attribution 2 0
2 cc-by-2.5 attribution (?:creative commons|cc) attribution 2 5
2 cc-by-3.0 attribution (?:creative commons|cc) attribution 3 0
2 cc-by-4.0 attribution (?:creative commons|cc) attribution 4 0
2 cc-by-sa-3.0 attribution (?:creative commons|cc) attribution share ?alike 3 0
2 cc-by-sa-4.0 attribution (?:creative commons|cc) attribution share ?alike 4 0
2 cc-by-nd-4.0 attribution (?:creative commons|cc) attribution no ?deriv(?:s|ative|atives) 4 0
2 cc-by-nc-3.0 attribution (?:creative commons|cc) attribution non ?commercial 3 0
2 cc-by-nc-4.0 attribution (?:creative commons|cc) attribution non ?commercial 4 0
2 cc-by-nc-sa-3.0 attribution (?:creative commons|cc) attribution non ?commercial share ?alike 3 0
2 cc-by-nc-sa-4.0 attribution (?:creative commons|cc) attribution non ?commercial share ?alike 4 0
2 cc-by-nc-nd-3.0 attribution (?:creative commons|cc) attribution non ?commercial no ?deriv(?:s|ative|atives) 3 0
2 cc-by-nc-nd-4.0 attribution (?:creative commons|cc) attribution non ?commercial no ?deriv(?:s|ative|atives) 4 0
2 cc-by-1.0 cc cc by 1 0
2 cc-by-2.0 cc cc by 2 0
2 cc-by-2.5 cc cc by 2 5
2 cc-by-3.0 cc cc by 3 0
2 cc-by-4.0 cc cc by 4 0
2 cc-by-sa-2.0 cc cc by sa 2 0
2 cc-by-sa-2.5 cc cc by sa 2 5
2 cc-by-sa-3.0 cc cc by sa 3 0
2 cc-by-sa-4.0 cc cc by sa 4 0
2 cc-by-nd-3.0 cc cc by nd 3 0
2 cc-by-nd-4.0 cc cc by nd 4 0
2 cc-by-nc-2.0 cc cc by nc 2 0
2 cc-by-nc-3.0 cc cc by nc 3 0
2 cc-by-nc-4.0 cc cc by nc 4 0
2 cc-by-nc-sa-3.0 cc cc by nc sa 3 0
2 cc-by-nc-sa-4.0 cc cc by nc sa 4 0
2 cc-by-nc-nd-3.0 cc cc by nc nd 3 0
2 cc-by-nc-nd-4.0 cc cc by nc nd 4 0
2 cc-by-3.0 creativecommons creativecommons org licenses by 3 0
2 cc-by-4.0 creativecommons creativecommons org licenses by 4 0
2 cc-by-sa-3.0 creativecommons creativecommons org licenses by sa 3 0
2 cc-by-sa-4.0 creativecommons creativecommons org licenses by sa 4 0
2 cc-by-nc-4.0 creativecommons creativecommons org licenses by nc 4 0
2 cc-by-nc-sa-4.0 creativecommons creativecommons org licenses by nc sa 4 0
2 cc-by-nc-nd-4.0 creativecommons creativecommons org licenses by nc nd 4 0
2 cc0-1.0 creativecommons creativecommons org publicdomain zero 1 0
2 artistic-1.0 artistic artistic licen[cs]e(?: v| version)? ?1 0
2 artistic-2.0 artistic artistic licen[cs]e(?: v| version)? ?2 0
2 boost-1.0 boost boost software licen[cs]e(?: v| version)? ?1 0
2 boost-1.0 bsl bsl 1 0
2 osl-3.0 open_software open software licen[cs]e(?: v| version)? ?3 0
2 afl-3.0 academic_free academic free licen[cs]e(?: v| version)? ?3 0
2 ecl-2.0 educational_community educational community licen[cs]e(?: v| version)? ?2 0
2 ofl-1.1 ofl* (?:sil )?ofl(?: v| version)? ?1 1
2 php-3.01 php php licen[cs]e(?: v| version)? ?3 01
2 zpl-2.1 zope zope public licen[cs]e(?: v| version)? ?2 1
2 lppl-1.3 lppl* lppl(?: v| version)? ?1 3
2 lppl-1.3 latex latex project public licen[cs]e(?: v| version)? ?1 3
2 cecill-2.1 cecill* cecill(?: v| version)? ?2 1
2 mulan-2.0 mulan mulan (?:psl|permissive software licen[cs]e)(?: v(?:ersion)?)? ?2
2 odbl-1.0 open_database (?:open data commons )?open database licen[cs]e(?: v| version)? ?1 0
2 busl-1.1 business_source business source licen[cs]e(?: v| version)? ?1 1
2 sspl-1.0 server_side server side public licen[cs]e(?: v| version)? ?1
2 ogl-3.0 open_government open government licen[cs]e(?: v| version)? ?3 0
3 mit licen* (?:the )?mit(?: x11)? licen[cs]e
3 mit licensed mit licensed
3 mit expat expat licen[cs]e
3 x11 x11 x11 licen[cs]e
3 isc isc (?:the )?isc licen[cs]e
3 bsd bsd bsd(?: style| type)? licen[cs]e
3 bsd bsd bsd licensed
3 apache apache apache (?:software )?licen[cs]e
3 apache apache apache licensed
3 gpl gpl (?:gnu )?gpl
3 gpl gnu gnu public licen[cs]e
3 lgpl lgpl (?:gnu )?lgpl
3 lgpl lesser_general (?:gnu )?lesser general public licen[cs]e
3 lgpl library_general (?:gnu )?library general public licen[cs]e
3 agpl agpl (?:gnu )?agpl
3 agpl affero (?:gnu )?affero general public licen[cs]e
3 gfdl gfdl (?:gnu )?gfdl
3 gfdl documentation (?:gnu )?free documentation licen[cs]e
3 mpl mozilla mozilla public licen[cs]e
3 epl eclipse eclipse public licen[cs]e
3 cddl cddl cddl
3 cddl common_development common development and distribution licen[cs]e
3 cpl common_public common public licen[cs]e
3 eupl eupl eupl
3 eupl european_union european union public licen[cs]e
3 cc-by-sa cc cc by sa
3 cc-by-nd cc cc by nd
3 cc-by-nc cc cc by nc
3 cc-by-nc-sa cc cc by nc sa
3 cc-by-nc-nd cc cc by nc nd
3 cc-by attribution (?:creative commons|cc) attribution
3 cc-by-sa attribution (?:creative commons|cc) attribution share ?alike
3 cc-by-nc attribution (?:creative commons|cc) attribution non ?commercial
3 creative-commons creative_commons creative commons(?: public)?(?: licen[cs]e)?
3 unlicense unlicense (?:the )?unlicense
3 wtfpl wtfpl wtfpl
3 zlib zlib zlib(?: libpng)? licen[cs]e
3 boost boost boost software licen[cs]e
3 artistic artistic artistic licen[cs]e
3 perl perl same terms as perl(?: itself)?
3 psf python python software foundation licen[cs]e
3 php php php licen[cs]e
3 ruby ruby ruby licen[cs]e
3 openssl openssl openssl licen[cs]e
3 sleepycat sleepycat sleepycat licen[cs]e
3 postgresql postgresql postgresql licen[cs]e
3 ncsa ncsa (?:university of illinois )?ncsa (?:open source )?licen[cs]e
3 ms-pl microsoft microsoft public licen[cs]e
3 ms-rl microsoft microsoft reciprocal licen[cs]e
3 ofl open_font (?:sil )?open font licen[cs]e
3 ubuntu-font ubuntu ubuntu font licen[cs]e
3 vim vim vim licen[cs]e
3 zpl zope zope public licen[cs]e
3 w3c w3c w3c software (?:notice and )?licen[cs]e
3 icu icu icu licen[cs]e
3 unicode unicode unicode (?:data files and software )?licen[cs]e
3 curl curl curl licen[cs]e
3 beerware beerware beerware(?: licen[cs]e)?
3 afl academic_free academic free licen[cs]e
3 osl open_software open software licen[cs]e
3 ecl educational_community educational community licen[cs]e
3 rpl reciprocal reciprocal public licen[cs]e
3 qpl q_public (?:the )?q public licen[cs]e
3 ipl ibm ibm public licen[cs]e
3 apsl apple_public apple public source licen[cs]e
3 nasa nasa nasa open source agreement
3 lppl latex latex project public licen[cs]e
3 tcl tcl tcl(?: tk)? licen[cs]e
3 hpnd historical_permission historical permission notice and disclaimer
3 blueoak blue_oak blue oak model licen[cs]e
3 mulan mulan mulan (?:psl|permissive software licen[cs]e)
3 cecill cecill cecill
3 odbl open_database open database licen[cs]e
3 odc-by open_data open data commons attribution(?: licen[cs]e)?
3 pddl dedication public domain dedication and licen[cs]e
3 ogl open_government open government licen[cs]e
3 sspl server_side server side public licen[cs]e
3 busl business_source business source licen[cs]e
3 elastic elastic elastic licen[cs]e
3 commons-clause clause commons clause
3 polyform polyform polyform(?: [^ ]+){1,3} licen[cs]e
3 llama llama llama(?: [0-9]){0,2} community licen[cs]e
3 openrail openrail (?:creativeml )?openrail(?: [^ ]+){0,2} licen[cs]e
3 openrail open_rail (?:creativeml )?open rail(?: [^ ]+){0,2} licen[cs]e
3 public-domain public_domain (?:released |placed |dedicated |put )?(?:in|into|to) the public domain
3 public-domain public_domain public domain
3 eula end_user end user licen[cs]e agreement
3 eula eula eula
4 license-mention spdx spdx licen[cs]e identifier(?: [^ ]+){1,4}
4 license-mention licen* (?:licensed|available|released|distributed|published|provided) under (?:the|a|an)(?: [^ ]+){1,4} licen[cs]e
4 license-mention licen* see (?:the )?licen[cs]e(?: [^ ]+){0,3} (?:file|for details|for more)
4 license-mention licen* licen[cs]e agreement
4 license-mention licen* terms (?:of|and conditions of) (?:the|this) licen[cs]e
4 license-mention licen* (?:open source|free software|permissive|proprietary|commercial) licen[cs]e
4 copyright copyright copyright(?: c)?(?: (?:19|20)[0-9][0-9]){1,4}
4 copyright copyright copyright (?:c|by|holders?|owners?|notice)
4 copyright copr copr (?:19|20)[0-9][0-9]
4 reserved reserved (?:some|no|all other) rights reserved
4 reserved derechos todos los derechos reservados
4 reserved droits tous droits réservés
4 reserved rechte alle rechte vorbehalten
4 reserved diritti tutti i diritti riservati
4 trademark trademark* registered trademarks? of
4 terms terms_of terms of (?:use|service)
4 shareware shareware shareware
4 freeware freeware freeware
4 noncommercial use_only for (?:personal and )?non ?commercial use only
4 noncommercial for_educational for educational (?:and research )?(?:use|purposes) only
"""


class Rule(NamedTuple):
    number: int
    rank: int
    label: str
    keyword: str
    pattern: str
    base: bool


def rules() -> list[Rule]:
    """All rules, numbered in order of priority: by rank, then as they stand, those of BASE first in theirs."""
    lines = [(line, base) for text, base in ((BASE, True), (RULES, False)) for line in text.strip().splitlines()]
    out = []
    for line, base in sorted(lines, key=lambda x: int(x[0][0])):
        rank, label, keyword, pattern = line.split(" ", 3)
        out.append(Rule(len(out), int(rank), label, keyword, pattern, base))
    return out
