"""Known licence texts and spellings: fixed values.

Whole texts are the files of ``license_texts`` (named by SPDX id) and the short
ones below; notices are the usual one-line forms of each licence's names.
"""

from pathlib import Path

#: spellings that licence matching treats as one, applied in this order to the canonical form
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("licence", "license"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_BSD_TOP = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_NUMBERS = str.maketrans("", "", "123")

#: title lines that may stand over a short text
_SHORT = {
    "MIT": (_MIT, ["MIT License", "The MIT License", "The MIT License (MIT)"]),
    "ISC": (_ISC, ["ISC License", "The ISC License", "ISC License (ISC)"]),
    "BSD-2-Clause": (_BSD_TOP + _BSD_END, ["BSD 2-Clause License", 'The 2-Clause BSD License', 'BSD 2-Clause "Simplified" License']),
    "BSD-3-Clause": (_BSD_TOP + _BSD_THIRD + _BSD_END, ["BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License']),
}


def _bodies(text: str) -> list[str]:
    """The text, and without what follows its terms (how to apply them, exhibits)."""
    out = [text]
    for mark, keep in (("END OF TERMS AND CONDITIONS", True), ("How to Apply These Terms", False), ("\nExhibit A -", False)):
        if mark in text:
            head = text.split(mark)[0]
            out += [head + mark, head] if keep else [head]
    return out + [x.replace("https://", "http://") for x in out] + [x.replace("http://", "https://") for x in out]


def _whole() -> list[tuple[str, str]]:
    out = []
    for name, (text, titles) in _SHORT.items():
        for body in (text, text.translate(_NUMBERS)):   # with and without the numbers of a list
            out += [(name, x + body) for x in ["", *(f"{t}\n\n" for t in titles), *(f"{t}\nAll rights reserved.\n" for t in titles), "All rights reserved.\n"]]
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        name = path.name.removesuffix(".txt").removesuffix(".regents")
        out += [(name, x) for x in _bodies(path.read_text(encoding="utf-8"))]
    return out


_GNU = [(f"{k}-{v}", f"GNU {n}General Public License", v) for k, n, versions in (
    ("GPL", "", ("2.0", "3.0")), ("LGPL", "Lesser ", ("2.1", "3.0")), ("AGPL", "Affero ", ("3.0",))) for v in versions]
_CC = [("CC-BY-4.0", "Attribution"), ("CC-BY-SA-4.0", "Attribution-ShareAlike"), ("CC-BY-NC-4.0", "Attribution-NonCommercial"),
       ("CC-BY-ND-4.0", "Attribution-NoDerivatives"), ("CC-BY-NC-SA-4.0", "Attribution-NonCommercial-ShareAlike"),
       ("CC-BY-NC-ND-4.0", "Attribution-NonCommercial-NoDerivatives")]


def _names() -> list[tuple[str, list[str], list[str]]]:
    """(licence, names in prose, SPDX ids)."""
    out = [("MIT", ["MIT License", "MIT"], ["MIT"]), ("ISC", ["ISC License", "ISC"], ["ISC"]),
           ("Apache-2.0", ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0"], ["Apache-2.0"]),
           ("MPL-2.0", ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"], ["MPL-2.0"]),
           ("Unlicense", ["Unlicense", "Unlicense License"], ["Unlicense"]),
           ("CC0-1.0", ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "CC0 1.0 Universal Public Domain Dedication"], ["CC0-1.0"])]
    for n, word in (("2", "Simplified"), ("3", "New")):
        out.append((f"BSD-{n}-Clause", [f"{n}-Clause BSD License", f"BSD {n}-Clause License", f"{word} BSD License"], [f"BSD-{n}-Clause"]))
    for spdx, name, v in _GNU:
        short = spdx.split("-")[0]
        numbers = [v, v.removesuffix(".0")] if v.endswith(".0") else [v]
        out.append((spdx, [x for n in numbers for x in (f"{name}, version {n}", f"{name} version {n}", f"{name} v{n}", f"{short} v{n}", f"{short}v{n}",
                                                        f"{name}, version {n} or later", f"{name}, version {n} only")] + [f"{short} {v}"],
                    [spdx, f"{spdx}-only", f"{spdx}-or-later", f"{spdx}+"]))
    for spdx, name in _CC:
        kind = spdx.removeprefix("CC-").removesuffix("-4.0")
        out.append((spdx, [f"CC {kind} 4.0", f"CC-{kind}-4.0", f"CC {kind} 4.0 License", f"Creative Commons {name} 4.0", f"Creative Commons {name} 4.0 License",
                           f"Creative Commons {name} 4.0 International", f"Creative Commons {name} 4.0 International License"], [spdx]))
    return out


_LEADS = ["Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under", "This software is licensed under",
          "This project is licensed under", "This work is released under"]


def _notices() -> list[tuple[str, str]]:
    out = []
    for spdx, names, ids in _names():
        out += [(spdx, f"{lead} {the}{name}.") for lead in _LEADS for the in ("", "the ", "a ") for name in names]
        out += [(spdx, f"SPDX-License-Identifier: {i}") for i in ids]
    return out


#: (licence, text): whole texts and the usual one-line notices
KNOWN = _whole() + _notices()
