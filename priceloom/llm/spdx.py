"""Texts, headers and short notices of common licenses, for the license scan.

``texts`` are whole texts and standard headers, looked for as templates. Short
notices have too few words for that, so ``names_at`` reads them by a rule: a
license's name, in one of its usual forms, after words that apply a license
("licensed under", "released under the terms of", "SPDX-License-Identifier") or
before a copyright line. Names follow SPDX."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import cache
from importlib.resources import files

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_4 = (
    "3. All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by the organization. 4. Neither the name of the "
    "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_END = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so"
)


def _gnu(name: str, version: str, later: bool, what: str = "program", by: str = "General") -> str:
    terms = (
        f"either version {version} of the License, or (at your option) any later version."
        if later
        else f"version {version} of the License."
    )
    return (
        f"This {what} is free software; you can redistribute it and/or modify it under the terms of the {name} as published "
        f"by the Free Software Foundation; {terms} This {what} is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        f"See the {name} for more details."
    )


_HEADERS = {
    "MIT-full-text": f"{_GRANT}, subject to the following conditions: The above copyright notice and this permission notice "
    f"shall be included in all copies or substantial portions of the Software. {_AS_IS}",
    "MIT-0-text": f"{_GRANT}. {_AS_IS}",
    "ISC-full-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    f"hereby granted, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}",
    "0BSD-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    f"hereby granted. {_ISC_END}",
    "BSD-2-Clause-full-text": _BSD + _BSD_END,
    "BSD-3-Clause-text": _BSD + _BSD_3 + _BSD_END,
    "BSD-4-Clause-text": _BSD + _BSD_4 + _BSD_END,
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
    "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
    "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to "
    "the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
    "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
    "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
    "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
    "distribution.",
    "BSL-1.0-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
    "software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
    "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
    "third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the "
    "Software and this entire statement, including the above license grant, this restriction and the following disclaimer, "
    "must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless "
    "such copies or derivative works are solely in the form of machine-executable object code generated by a source "
    "language processor.",
    "WTFPL-text": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and "
    "changing it is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS "
    "FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
    "to this work.",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "GPL-2.0-only-header": _gnu("GNU General Public License", "2", False),
    "GPL-2.0-or-later-header": _gnu("GNU General Public License", "2", True),
    "GPL-3.0-only-header": _gnu("GNU General Public License", "3", False),
    "GPL-3.0-or-later-full-header": _gnu("GNU General Public License", "3", True),
    "LGPL-2.1-only-header": _gnu("GNU Lesser General Public License", "2.1", False, "library"),
    "LGPL-2.1-or-later-header": _gnu("GNU Lesser General Public License", "2.1", True, "library"),
    "LGPL-3.0-or-later-header": _gnu("GNU Lesser General Public License", "3", True),
    "AGPL-3.0-only-header": _gnu("GNU Affero General Public License", "3", False),
    "AGPL-3.0-or-later-header": _gnu("GNU Affero General Public License", "3", True),
}


@cache
def texts() -> dict[str, str]:
    """Whole texts (``license_texts``) and headers, by name. Read by the driver."""
    found = sorted((f for f in (files("priceloom.llm") / "license_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return _HEADERS | {f"{f.name[:-4]}-full-text": f.read_text("utf-8") for f in found}


# Short notices: lower-cased words with one space between them.
_CODE = r"(?: licen[sc]es?)?"
_V = r"(?: licen[sc]e)?(?: version| v)? ?v?"
_CC_KINDS = {
    "by nc nd": "BY-NC-ND", "by nc sa": "BY-NC-SA", "by nc": "BY-NC", "by nd": "BY-ND", "by sa": "BY-SA", "by": "BY",
    "attribution noncommercial noderivatives": "BY-NC-ND", "attribution noncommercial noderivs": "BY-NC-ND",
    "attribution non commercial no derivatives": "BY-NC-ND", "attribution noncommercial sharealike": "BY-NC-SA",
    "attribution non commercial share alike": "BY-NC-SA", "attribution noncommercial": "BY-NC",
    "attribution non commercial": "BY-NC", "attribution noderivatives": "BY-ND", "attribution noderivs": "BY-ND",
    "attribution no derivatives": "BY-ND", "attribution sharealike": "BY-SA", "attribution share alike": "BY-SA",
    "attribution": "BY",
}
_LATER = r"(?: only| (?:or|and)(?: at your option)?(?: any)? (?:later|newer|above)(?: versions?)?)?"
_GNU = (
    ("AGPL", r"(?:gnu )?(?:affero general public licen[sc]e|affero gpl|agpl)"),
    ("LGPL", r"(?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lesser gpl|lgpl)"),
    ("GPL", r"(?:gnu general public licen[sc]e|general public licen[sc]e|gnu gpl|gpl)"),
    ("GFDL", r"(?:gnu )?(?:free documentation licen[sc]e|fdl|gfdl)"),
)
#: (form of the name, its license, whether it names nothing but a license)
_NAMES: list[tuple[str, str, bool]] = [
    (r"mit 0|mit no attribution" + _CODE, "MIT-0", True),
    (r"mit(?: x11| expat)? licen[sc]e|expat licen[sc]e|x11 licen[sc]e", "MIT", True),
    (r"mit", "MIT", False),
    (r"apache(?: software)?" + _V + r"1 1" + _CODE, "Apache-1.1", True),
    (r"apache(?: software)?" + _V + r"2(?: 0)?" + _CODE, "Apache-2.0", True),
    (r"asl 2 0|al 2 0", "Apache-2.0", False),
    (r"apache(?: software)? licen[sc]e", "Apache", True),
    (r"(?:bsd zero clause|zero clause bsd|0bsd|0 clause bsd)" + _CODE, "0BSD", True),
    *[
        (rf"(?:bsd (?:{n}|{w}) clause|(?:{n}|{w}) clause bsd{x})" + _CODE, f"BSD-{n}-Clause", True)
        for n, w, x in (("2", "two", "|simplified bsd|freebsd"), ("3", "three", "|new bsd|modified bsd|revised bsd"), ("4", "four", "|original bsd"))
    ],
    (r"bsd(?: style)? licen[sc]e", "BSD", True),
    (r"bsd", "BSD", False),
    (r"isc licen[sc]e", "ISC", True),
    (r"isc", "ISC", False),
    *[
        (rf"(?:mozilla public licen[sc]e|mpl)(?: version| v)? ?v?{n} {m}" + _CODE, f"MPL-{n}.{m}", True)
        for n, m in ((2, 0), (1, 1))
    ],
    *[(rf"(?:eclipse public licen[sc]e|epl)(?: version| v)? ?v?{n} ?0" + _CODE, f"EPL-{n}.0", True) for n in (2, 1)],
    (r"(?:common development and distribution licen[sc]e|cddl)(?: version| v)? ?v?1 0", "CDDL-1.0", True),
    (r"(?:european union public licen[sc]e|eupl)(?: version| v)? ?v?1 2", "EUPL-1.2", True),
    (r"(?:boost software licen[sc]e|bsl)(?: version| v)? ?v?1 0|boost software licen[sc]e", "BSL-1.0", True),
    (r"artistic licen[sc]e(?: version)? ?v?2 0|artistic 2 0", "Artistic-2.0", True),
    (r"zlib(?: libpng)? licen[sc]e", "Zlib", True),
    (r"zlib", "Zlib", False),
    (r"unlicense|the unlicense", "Unlicense", True),
    (r"wtfpl|do what the fuck you want to public licen[sc]e", "WTFPL", True),
    (r"(?:sil )?open font licen[sc]e(?: version)? ?v?1 1|ofl 1 1", "OFL-1.1", True),
    (r"open database licen[sc]e|odbl(?: v?1 0)?", "ODbL-1.0", True),
    (r"(?:creative commons |cc )?(?:cc0|zero)(?: universal)?(?: v?1 0)?(?: universal)?(?: public domain dedication)?" + _CODE, "CC0-1.0", True),
]
_PATTERNS = [(re.compile(rf"(?:{form})(?= |$)"), license, sure) for form, license, sure in _NAMES]
_CC = re.compile(
    r"(?:creative commons|cc|creativecommons)(?: licen[sc]es?)? (" + "|".join(sorted(_CC_KINDS, key=len, reverse=True)) +
    r")(?: licen[sc]e)?(?: version| v)?(?: ?v?([1-4]) ?([05]))?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?(?= |$)"
)
_FREE = [
    (re.compile(rf"{form}(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?v?(?:([123])(?: ([01]))?)?{_LATER}(?: licen[sc]e)?(?= |$)"), name)
    for name, form in _GNU
]
_VERSIONS = {"GPL": "1.0 2.0 3.0", "LGPL": "2.0 2.1 3.0", "AGPL": "1.0 3.0", "GFDL": "1.1 1.2 1.3"}
_FILLER = r"(?: (?:the|a|an|terms|of|conditions|either|both|and|version|standard|permissive|open|source|free|software|following|osi|approved))*"
_VERB = (
    r"(?:dual )?(?:(?:re)?licen[sc]ed|sublicen[sc]ed|released|re?distributed|distributed|available|published|provided|shared|"
    r"covered|governed|offered|issued|placed|redistributable|redistribute|distribute|modify|use|used|donated|dedicated|contributed)"
)
_APPLIES = re.compile(rf"(?:^| ){_VERB}(?: \S+){{0,3}}? (?:under|by|with|via|to|as){_FILLER}$|(?:^| )(?:spdx licen[sc]e identifier|licen[sc]ed?(?: is)?(?: osi approved)?){_FILLER}$")
_UNDER = re.compile(rf"(?:^| )(?:under|per){_FILLER}$")
_JOINED = re.compile(r"(?:(?: licen[sc]e)?(?: or| and| either| the| a| an| with))*$")
_COPYRIGHT = re.compile(r" (?:version \S+ \S+ )?copyright ")

#: Words with which a name begins.
ANCHORS = (
    "mit expat x11 apache asl al bsd 0bsd zero two three four 0 2 3 4 simplified new modified revised original freebsd isc mozilla mpl "
    "mplv2 eclipse epl common cddl european eupl boost bsl artistic zlib unlicense wtfpl do sil open ofl odbl creative cc cc0 "
    "creativecommons gnu affero agpl agplv3 lesser library lgpl lgplv2 lgplv3 general gpl gplv1 gplv2 gplv3 free fdl gfdl"
).split()
BEFORE, AFTER = 14, 24


def _free(words: str) -> tuple[int, str, bool] | None:
    for pattern, name in _FREE:
        if m := pattern.match(words):
            major, minor = m.group(1), m.group(2) or "0"
            later = " later" in m.group() or " newer" in m.group() or " above" in m.group()
            if major and f"{major}.{minor}" in _VERSIONS[name].split():
                end = "-or-later" if later else "-only" if " only" in m.group() else ""
                return m.end(), f"{name}-{major}.{minor}{end}", True
            return m.end(), name, "licen" in m.group() or bool(major)
    return None


def _name(words: str) -> tuple[int, str, bool] | None:
    """The longest name at the start of the words: its length, its license, and
    whether it names nothing but a license."""
    found = [(m.end(), license, sure) for pattern, license, sure in _PATTERNS if (m := pattern.match(words))]
    if m := _CC.match(words):
        found.append((m.end(), f"CC-{_CC_KINDS[m.group(1)]}" + (f"-{m.group(2)}.{m.group(3)}" if m.group(2) else ""), True))
    if free := _free(re.sub(r"^(a?gpl|lgpl|gfdl)v(?=[123])", r"\1 ", words)):
        grown = len(words) - len(re.sub(r"^(a?gpl|lgpl|gfdl)v(?=[123])", r"\1 ", words))
        found.append((free[0] + grown, *free[1:]))
    return max(found, key=lambda x: x[0], default=None)


def names_at(words: Sequence[str], places: Sequence[int]) -> Iterator[tuple[int, int, str]]:
    """(first word, last word, license) of each short notice; places are those of
    the anchors among the lower-cased words of one text."""
    done = -1
    for at in places:
        if at <= done:
            continue
        named = _name(" ".join(words[at : at + AFTER]))
        if named is None:
            continue
        length, license, sure = named
        last = at + " ".join(words[at : at + AFTER])[:length].strip().count(" ")
        before = " ".join(words[max(0, at - BEFORE) : at])
        after = " " + " ".join(words[last + 1 : last + 4]) + " "
        follows = done >= 0 and at - done <= 6 and _JOINED.match(" " + " ".join(words[done + 1 : at]) if done + 1 < at else "")
        lead = _APPLIES.search(before) or (_UNDER.search(before) if sure else None)
        if not (lead or follows or (sure and _COPYRIGHT.match(after))):
            continue
        first = at
        if lead:
            first = at - before[lead.start() :].strip().count(" ") - 1
        yield first, last, license
        done = last
