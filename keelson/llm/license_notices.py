"""Notices and texts of the licenses that the license scan covers: (license, text, words that must match).

Full texts lie in ``license_texts``; the MIT, BSD and ISC texts and the notices are written here. Family members that
share most words (the BSD, GPL and CC families) are told apart by the words that must match and by ``licenses.best``.
"""

from __future__ import annotations

import pkgutil

_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
"""
_MIT = _GRANT + """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
%sTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_GNU = """This %s is free software; you can redistribute it and/or modify it under the terms of the GNU %sGeneral Public License
as published by the Free Software Foundation; either version %s of the License, or (at your option) any later version."""
_CC0 = """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this
work."""

_GNUS = [("GPL-2.0", "", "2", "GPL"), ("GPL-3.0", "", "3", "GPL"), ("LGPL-2.0", "Library ", "2", "LGPL"),
         ("LGPL-2.1", "Lesser ", "2.1", "LGPL"), ("LGPL-3.0", "Lesser ", "3", "LGPL"), ("AGPL-3.0", "Affero ", "3", "AGPL")]
_FULL = {"Apache-2.0": "Apache 2 0", "GPL-2.0": "GNU General 2", "GPL-3.0": "GNU General 3", "LGPL-2.0": "GNU Library 2",
         "LGPL-2.1": "GNU Lesser 2 1", "LGPL-3.0": "GNU Lesser 3", "AGPL-3.0": "GNU Affero 3", "MPL-2.0": "Mozilla 2 0",
         "CC0-1.0": "CC0 1 0"}
_CC_WORDS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
_CC_PLACES = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}


def _short(license: str, says: list[str], named: str):
    for name in says:
        yield license, f"Licensed under the {name}.", named
        yield license, f"This work is licensed under the {name}.", named
        yield license, f"Released under the {name}.", named
        yield license, f"Licensed under the terms of the {name}.", named


def covered() -> list[tuple[str, str, str]]:
    text = lambda name: pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()
    out = [("MIT", _MIT, ""), ("ISC", _ISC, ""), ("BSD-2-Clause", _BSD % "", ""),
           ("BSD-3-Clause", _BSD % _THIRD, "neither endorse promote"), ("Apache-2.0", _APACHE, "Apache 2 0"),
           ("MPL-2.0", _MPL, "Mozilla 2 0"), ("CC0-1.0", _CC0, "waived neighboring")]
    out += [(name, text(name), named) for name, named in _FULL.items()]
    out += _short("MIT", ["MIT License"], "MIT")
    out += _short("ISC", ["ISC License"], "ISC")
    for n, words in (("2", "Simplified"), ("3", "New")):
        out += _short(f"BSD-{n}-Clause", [f"BSD {n}-Clause License", f"{n}-Clause BSD License"], f"BSD {n} Clause")
        out += _short(f"BSD-{n}-Clause", [f"{words} BSD License"], f"BSD {words}")
    out += _short("Apache-2.0", ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"], "Apache 2 0")
    out += _short("MPL-2.0", ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"], "Mozilla 2 0")
    out += _short("MPL-2.0", ["MPL 2.0"], "MPL 2 0")
    for name, kind, version, brief in _GNUS:
        named = f"GNU {kind or 'General '}{version}"
        out += [(name, _GNU % (what, kind, version), named) for what in ("program", "library")]
        out += _short(name, [f"GNU {kind}General Public License, version {version}"], named)
        for v in dict.fromkeys([version, version if "." in version else f"{version}.0"]):
            out += _short(name, [f"GNU {kind}General Public License v{v}"], f"GNU {kind or 'General '}v{v}")
            out += _short(name, [f"{brief}v{v}"], f"{brief}v{v}")
            out += _short(name, [f"{brief} v{v}"], f"{brief} v{v}")
        out.append((name, f"SPDX-License-Identifier: {name}", f"SPDX {name}"))
    for parts in (["BY"], ["BY", "SA"], ["BY", "ND"], ["BY", "NC"], ["BY", "NC", "SA"], ["BY", "NC", "ND"]):
        brief, words = "-".join(parts), "-".join(_CC_WORDS[p] for p in parts)
        for version, place in _CC_PLACES.items():
            name = f"CC-{brief}-{version}"
            out += [(name, f"Licensed under CC {brief} {version}.", f"CC {brief} {version}"),
                    (name, f"This work is licensed under CC {brief} {version}.", f"CC {brief} {version}"),
                    (name, f"This work is licensed under a Creative Commons {words} {version} {place} License.",
                     f"Commons {words} {version}"),
                    (name, f"SPDX-License-Identifier: {name}", f"SPDX {name}")]
        out.append((f"CC-{brief}-4.0", text(f"CC-{brief}-4.0"), f"Commons {words} 4 0"))
    out += _short("CC0-1.0", ["CC0 1.0"], "CC0 1 0")
    for name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "CC0-1.0"):
        out.append((name, f"SPDX-License-Identifier: {name}", f"SPDX {name}"))
    return out
