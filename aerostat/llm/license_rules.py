"""Signature rules of licences: names, the ways in which texts refer to them, and their own wording.

Patterns run over lower-case words with one blank between them; punctuation is gone, so "CC BY-NC
4.0" reads ``cc by nc 4 0``. A rule has a level, 0 being the strongest.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Phrases whose every place is reported, and their labels.
BASE = """
mit        | license | under the mit license
apache-2   | apache  | apache license version 2
cc-by-nc   | cc      | cc by nc
"""

# label | word that any text with the name holds | identifier in tags | name in prose
NAMES = r"""
0bsd            | 0bsd         | 0bsd                              | 0bsd( licen[cs]e)?
0bsd            | bsd          | 0bsd                              | (zero clause bsd|bsd (0|zero) clause)( licen[cs]e)?
afl-3           | academic     | afl 3 0                           | academic free licen[cs]e( version| v)?( 3( 0)?)?
agpl-3          | affero       | agpl 3 0( only| or later)?        | (gnu )?affero (general public licen[cs]e|gpl)( version| v)?( 3( 0)?)?
agpl-3          | agpl         | agpl 3 0( only| or later)?        | (gnu )?agpl( version| v)? 3( 0)?
agpl-3          | agplv3       | agplv3                            | (gnu )?agplv3
apache-1        | apache       | apache 1 [01]                     | apache (software )?licen[cs]e (version |v )?1( [01])?
apache-2        | apache       | apache 2( 0)?                     | apache (software )?licen[cs]e (version |v )?2( 0)?
apache-2        | apache       | apache 2( 0)?                     | apache 2( 0)?( licen[cs]e)?
apache-2        | asl          | asl 2( 0)?                        | asl 2 0
artistic-2      | artistic     | artistic 2 0                      | artistic licen[cs]e( version| v)? 2( 0)?
artistic-1      | artistic     | artistic 1 0                      | (perl )?artistic licen[cs]e( version| v)? 1( 0)?
beerware        | beerware     | beerware                          | beerware( licen[cs]e)?
blueoak-1       | oak          | blueoak 1 0 0                     | blue oak model licen[cs]e( 1 0 0)?
bsd-2-clause    | bsd          | bsd 2 clause                      | (bsd (2|two) clause|(2|two) clause bsd|(simplified|freebsd) bsd)( licen[cs]e)?
bsd-3-clause    | bsd          | bsd 3 clause                      | (bsd (3|three) clause|(3|three) clause bsd|(modified|revised|new) bsd)( licen[cs]e)?
bsd-4-clause    | bsd          | bsd 4 clause                      | (bsd (4|four) clause|(4|four) clause bsd|original bsd)( licen[cs]e)?
bsd             | bsd          | bsd                               | bsd( style)? licen[cs]e
bsl-1           | boost        | bsl 1 0                           | boost software licen[cs]e( version| v)?( 1( 0)?)?
busl-1          | business     | busl 1 1                          | business source licen[cs]e( version| v)?( 1 1)?
cc0-1           | cc0          | cc0 1 0                           | cc0( 1 0)?( universal)?
cc0-1           | creative     | cc0 1 0                           | creative commons (zero|cc0)( 1 0)?
cc-by           | cc           | cc by [1-4] [05]                  | cc by( [1-4] [05])( international| unported)?
cc-by           | creative     | cc by [1-4] [05]                  | creative commons attribution( [1-4] [05])?( international| unported)?
cc-by-sa        | cc           | cc by sa( [1-4] [05])?            | cc by sa( [1-4] [05])?( international| unported)?
cc-by-sa        | creative     | cc by sa( [1-4] [05])?            | creative commons attribution share ?alike( [1-4] [05])?
cc-by-nc        | cc           | cc by nc( [1-4] [05])?            | cc by nc( [1-4] [05])( international| unported)?
cc-by-nc        | creative     | cc by nc( [1-4] [05])?            | creative commons attribution non ?commercial( [1-4] [05])?
cc-by-nd        | cc           | cc by nd( [1-4] [05])?            | cc by nd( [1-4] [05])?( international| unported)?
cc-by-nd        | creative     | cc by nd( [1-4] [05])?            | creative commons attribution no ?deriv(s|atives)( [1-4] [05])?
cc-by-nc-sa     | cc           | cc by nc sa( [1-4] [05])?         | cc by nc sa( [1-4] [05])?( international| unported)?
cc-by-nc-sa     | creative     | cc by nc sa( [1-4] [05])?         | creative commons attribution non ?commercial share ?alike( [1-4] [05])?
cc-by-nc-nd     | cc           | cc by nc nd( [1-4] [05])?         | cc by nc nd( [1-4] [05])?( international| unported)?
cc-by-nc-nd     | creative     | cc by nc nd( [1-4] [05])?         | creative commons attribution non ?commercial no ?deriv(s|atives)( [1-4] [05])?
cddl-1          | cddl         | cddl 1 [01]                       | cddl( version| v)?( 1( [01])?)?
cddl-1          | distribution | cddl 1 [01]                       | common development and distribution licen[cs]e( version| v)?( 1( [01])?)?
cecill-2        | cecill       | cecill 2 [01]                     | cecill( licen[cs]e)?( version| v)? 2( [01])?
cecill-b        | cecill       | cecill b                          | cecill b( licen[cs]e)?
cecill-c        | cecill       | cecill c                          | cecill c( licen[cs]e)?
cpal-1          | cpal         | cpal 1 0                          | cpal( version| v)?( 1( 0)?)?
cpal-1          | attribution  | cpal 1 0                          | common public attribution licen[cs]e( version| v)?( 1( 0)?)?
cpl-1           | common       | cpl 1 0                           | common public licen[cs]e( version| v)?( 1( 0)?)?
ecl-2           | educational  | ecl 2 0                           | educational community licen[cs]e( version| v)?( 2( 0)?)?
efl-2           | eiffel       | efl 2 0                           | eiffel forum licen[cs]e( version| v)?( 2)?
elastic-2       | elastic      | elastic 2 0                       | elastic licen[cs]e( version| v)?( 2( 0)?)?
epl-1           | eclipse      | epl 1 0                           | eclipse public licen[cs]e( version| v)? 1( 0)?
epl-2           | eclipse      | epl 2 0                           | eclipse public licen[cs]e( version| v)? 2( 0)?
eupl-1          | european     | eupl 1 [012]                      | european union public licen[cs]e( version| v)?( 1( [012])?)?
eupl-1          | eupl         | eupl 1 [012]                      | eupl( version| v)?( 1( [012])?)
gfdl-1          | documentation | gfdl 1 [123]( only| or later)?    | (gnu )?free documentation licen[cs]e( version| v)?( 1( [123])?)?
gfdl-1          | gfdl         | gfdl 1 [123]( only| or later)?    | (gnu )?gfdl( version| v)?( 1( [123])?)?
gpl-2           | general      | gpl 2 0( only| or later)?         | (gnu )?general public licen[cs]e( as published by the free software foundation)?( either)?( version| v)? 2( 0)?
gpl-2           | gpl          | gpl 2 0( only| or later)?         | (gnu )?gpl( version| v)? 2( 0)?( only| or later)?
gpl-2           | gplv2        | gplv2                             | (gnu )?gplv2
gpl-3           | general      | gpl 3 0( only| or later)?         | (gnu )?general public licen[cs]e( as published by the free software foundation)?( either)?( version| v)? 3( 0)?
gpl-3           | gpl          | gpl 3 0( only| or later)?         | (gnu )?gpl( version| v)? 3( 0)?( only| or later)?
gpl-3           | gplv3        | gplv3                             | (gnu )?gplv3
gpl             | general      | gpl                               | gnu general public licen[cs]e
gpl             | gpl          | gpl                               | (gnu gpl|gpl licen[cs]e)
hpnd            | historical   | hpnd                              | historical permission notice and disclaimer
icu             | icu          | icu                               | icu licen[cs]e
ijg             | jpeg         | ijg                               | independent jpeg group licen[cs]e
ipl-1           | ibm          | ipl 1 0                           | ibm public licen[cs]e( version| v)?( 1( 0)?)?
isc             | isc          | isc                               | isc( style)? licen[cs]e
lgpl-2          | lesser       | lgpl 2 [01]( only| or later)?     | (gnu )?lesser general public licen[cs]e( as published by the free software foundation)?( either)?( version| v)? 2( [01])?
lgpl-2          | library      | lgpl 2 [01]( only| or later)?     | (gnu )?library general public licen[cs]e( as published by the free software foundation)?( either)?( version| v)? 2( [01])?
lgpl-2          | lgpl         | lgpl 2 [01]( only| or later)?     | (gnu )?lgpl( version| v)? 2( [01])?( only| or later)?
lgpl-3          | lesser       | lgpl 3 0( only| or later)?        | (gnu )?lesser general public licen[cs]e( as published by the free software foundation)?( either)?( version| v)? 3( 0)?
lgpl-3          | lgpl         | lgpl 3 0( only| or later)?        | (gnu )?lgpl( version| v)? 3( 0)?( only| or later)?
lgpl            | lesser       | lgpl                              | (gnu )?lesser general public licen[cs]e
libpng          | libpng       | libpng( 2 0)?                     | libpng licen[cs]e( version| v)?( 2)?
lppl-1          | latex        | lppl 1 [0123]c?                   | latex project public licen[cs]e( version| v)?( 1( [0123]c?)?)?
mit-0           | mit          | mit 0                             | mit (0|no attribution)( licen[cs]e)
mit             | mit          | mit                               | (the )?mit( expat)? licen[cs]e
mit             | expat        | mit                               | expat licen[cs]e
mpl-1           | mozilla      | mpl 1 [01]                        | mozilla public licen[cs]e( version| v)? 1( [01])?
mpl-2           | mozilla      | mpl 2 0                           | mozilla public licen[cs]e( version| v)? 2( 0)?
mpl-2           | mpl          | mpl 2 0                           | mpl( version| v)? 2( 0)?
ms-pl           | microsoft    | ms pl                             | microsoft public licen[cs]e
ms-rl           | microsoft    | ms rl                             | microsoft reciprocal licen[cs]e
mulan-2         | mulan        | mulanpsl 2 0                      | mulan (psl|permissive software licen[cs]e)( version| v)?( 2)?
ncsa            | ncsa         | ncsa                              | (university of illinois )?ncsa (open source )?licen[cs]e
odbl-1          | odbl         | odbl 1 0                          | odbl( 1 0)?
odbl-1          | database     | odbl 1 0                          | open database licen[cs]e( version| v)?( 1( 0)?)?
odc-by-1        | odc          | odc by 1 0                        | odc by( 1 0)?
odc-by-1        | commons      | odc by 1 0                        | open data commons attribution licen[cs]e( 1 0)?
ofl-1           | ofl          | ofl 1 [01]                        | (sil )?ofl( version| v)? 1 1
ofl-1           | sil          | ofl 1 [01]                        | sil open font licen[cs]e( version| v)?( 1( 1)?)?
openssl         | openssl      | openssl                           | openssl licen[cs]e
osl-3           | open         | osl 3 0                           | open software licen[cs]e( version| v)?( 3( 0)?)?
php-3           | php          | php 3 (0|01)                      | php licen[cs]e( version| v)?( 3( 01?)?)?
postgresql      | postgresql   | postgresql                        | postgresql licen[cs]e
psf-2           | python       | psf 2 0                           | python software foundation licen[cs]e( version| v)?( 2)?
qpl-1           | qt           | qpl 1 0                           | qt public licen[cs]e( version| v)?( 1( 0)?)?
rpl-1           | reciprocal   | rpl 1 [15]                        | reciprocal public licen[cs]e( version| v)?( 1 [15])?
ruby            | ruby         | ruby                              | ruby licen[cs]e
sspl-1          | sspl         | sspl 1 0                          | sspl( version| v)?( 1( 0)?)?
sspl-1          | server       | sspl 1 0                          | server side public licen[cs]e( version| v)?( 1( 0)?)?
unicode         | unicode      | unicode dfs 201[56]               | unicode( inc)? licen[cs]e( agreement)?
unlicense       | unlicense    | unlicense                         | (the )?unlicense
upl-1           | universal    | upl 1 0                           | universal permissive licen[cs]e( version| v)?( 1( 0)?)?
vim             | vim          | vim                               | vim licen[cs]e
w3c             | w3c          | w3c                               | w3c( software)?( notice and)? licen[cs]e
wtfpl           | wtfpl        | wtfpl                             | wtfpl( version| v)?( 2)?
x11             | x11          | x11                               | (mit )?x11 licen[cs]e
zlib            | zlib         | zlib                              | zlib( libpng)? licen[cs]e
zpl-2           | zope         | zpl 2 [01]                        | zope public licen[cs]e( version| v)?( 2( [01])?)?
"""

# level | reference to a licence: {id} and {name} stand for those of each licence
REFERENCES = r"""
2 | spdx licen[cs]e identifier {id}
3 | (licen[cs]ed|released|distributed|published|provided|available|covered|offered|shared|redistributed)( [^ ]+)?( only)? under( the)?( terms( and conditions)? of)?( the)? {name}
3 | (lizenziert|veröffentlicht|freigegeben|verfügbar|vertrieben|steht) unter( der| einer)? {name}( lizenz)?
3 | (distribuée?s?|publiée?s?|diffusée?s?|disponibles?) sous( la)?( licence)? {name}
3 | (licenciad[oa]s?|publicad[oa]s?|distribuid[oa]s?|disponibles?) bajo( los términos de)?( la)?( licencia)? {name}
4 | {name}
"""

# label | word that any text with the passage holds | passage of the licence's or notice's own wording
PASSAGES = r"""
mit              | obtaining     | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit              | sublicense    | to use copy modify merge publish distribute sublicense and or sell copies of the software
mit              | noninfringement | fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable
isc              | purpose       | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
0bsd             | purpose       | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software
hpnd             | documentation | permission to use copy modify and distribute this software and its documentation for any purpose( and without fee)? is hereby granted
bsd              | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd              | redistributions | redistributions of source code must retain the above copyright notice
bsd              | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause     | endorse       | neither the name of( the)?( [^ ]+){1,6} nor the names of its contributors may be used to endorse or promote products
bsd-4-clause     | advertising   | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
apache-2         | compliance    | you may not use this file except in compliance with the license you may obtain a copy of the license at
apache-2         | apache        | http www apache org licenses license 2 0
apache-1         | apache        | this product includes software developed by the apache (software foundation|group)
gpl              | redistribute  | this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl-2            | redistribute  | redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e
gpl-3            | redistribute  | redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e
gpl              | distributed   | this program is distributed in the hope that it will be useful but without any warranty
gpl              | received      | you should have received a copy of the gnu general public licen[cs]e along with this program
gpl-2            | gnu           | http www gnu org licenses( old licenses)? gpl 2 0
gpl-3            | gnu           | http www gnu org licenses gpl 3 0
lgpl             | redistribute  | this library is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public licen[cs]e
lgpl             | received      | you should have received a copy of the gnu (lesser|library) general public licen[cs]e along with this library
agpl-3           | affero        | under the terms of the gnu affero general public licen[cs]e as published by the free software foundation( either)? version 3
mpl-2            | mozilla       | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-1            | mozilla       | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
mpl-2            | mozilla       | mozilla org mpl 2 0
epl-2            | eclipse       | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e 2 0
epl-1            | eclipse       | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0
cddl-1           | development   | the contents of this file are subject to the terms of the common development and distribution licen[cs]e
bsl-1            | boost         | boost org license 1 0
bsl-1            | boost         | use modification and distribution( are)? subject to the boost software licen[cs]e
zlib             | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib             | altered       | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
unlicense        | unencumbered  | this is free and unencumbered software released into the public domain
wtfpl            | want          | you just do what the [^ ]+ you want to
beerware         | beer          | if we meet some day and you think this stuff is worth it you can buy me a beer in return
cc0-1            | waived        | (has|have) waived all copyright and related or neighbou?ring rights
cc0-1            | creativecommons | creativecommons org publicdomain zero
cc-by            | creativecommons | creativecommons org licenses by [1-4]
cc-by-sa         | creativecommons | creativecommons org licenses by sa
cc-by-nc         | creativecommons | creativecommons org licenses by nc [1-4]
cc-by-nd         | creativecommons | creativecommons org licenses by nd
cc-by-nc-sa      | creativecommons | creativecommons org licenses by nc sa
cc-by-nc-nd      | creativecommons | creativecommons org licenses by nc nd
ofl-1            | font          | this font software is licensed under the sil open font licen[cs]e version 1 1
gfdl-1           | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
artistic-2       | artistic      | you can redistribute it and or modify it under the terms of the artistic licen[cs]e 2 0
perl             | perl          | under the same terms as perl itself
psf-2            | python        | python software foundation licen[cs]e version 2
openssl          | openssl       | this product includes software developed by the openssl project
unicode          | unicode       | unicode inc license agreement data files and software
public-domain    | public        | (released|placed|dedicated|put)( in| into| to) the public domain
public-domain    | public        | (this|the) (work|file|software|text|code) is( in)? the public domain
all-rights       | reserved      | all rights reserved
all-rights       | rechte        | alle rechte vorbehalten
all-rights       | droits        | tous droits réservés
all-rights       | derechos      | todos los derechos reservados
proprietary      | proprietary   | (proprietary and confidential|confidential and proprietary)
proprietary      | unauthorized  | unauthorized (copying|use|reproduction|distribution)( or distribution)? (of this (file|software|document|work)( via any medium)? )?is (strictly )?prohibited
proprietary      | unauthorised  | unauthorised (copying|use|reproduction|distribution)( or distribution)? (of this (file|software|document|work)( via any medium)? )?is (strictly )?prohibited
non-commercial   | commercial    | (for|is) (non ?commercial|personal and non ?commercial) use only
"""

PASSAGE = 1  # level of passages
TAG = 2  # level of tags, which hold the identifier and not the name
CONFIDENCE = [1.0, 0.98, 0.95, 0.9, 0.6]  # of the levels


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str  # a word of every match
    level: int
    pattern: str

    @property
    def spaced(self) -> str:
        """The pattern over text in which every word has a blank of its own on either side."""
        grouped = re.sub(r"[(]", "(?:", self.pattern)
        blanks = grouped.replace("[^ ]", "\0").replace(" ", "  ").replace("\0", "[^ ]")
        return f" {blanks} "


def _cells(table: str, columns: int) -> list[list[str]]:
    return [[cell.strip() for cell in re.split(" +[|] +", line, maxsplit=columns - 1)] for line in table.strip().splitlines()]


def rules() -> list[Rule]:
    """All rules; among equals the earlier one wins."""
    found = [Rule(label, keyword, 0, phrase) for label, keyword, phrase in _cells(BASE, 3)]
    found += [Rule(label, keyword, PASSAGE, passage) for label, keyword, passage in _cells(PASSAGES, 3)]
    for level, reference in _cells(REFERENCES, 2):
        for label, keyword, tag, name in _cells(NAMES, 4):
            pattern = reference.replace("{id}", tag).replace("{name}", f"({name})")
            found.append(Rule(label, "spdx" if int(level) == TAG else keyword, int(level), pattern))
    return list(dict.fromkeys(found))
