"""Known licence texts and notices (fixed values): name and whole text, paragraphs parted by an empty line, without copyright lines.

Long texts are the files of ``license_files``. What texts of a licence may lack or have is spelled out as one entry each:
titles, heads that state a publisher's address, instructions behind the terms.
"""

import re
from importlib.resources import files

_AS_IS_MIT = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_AS_IS_ISC = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

_GNU_WEB = ". If not, see <https://www.gnu.org/licenses/>."
_GNU_MAIL = """; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA
02110-1301 USA"""

_SHORT: list[tuple[str, str]] = [
    ("MIT", f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

{_AS_IS_MIT}"""),
    ("ISC", f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

{_AS_IS_ISC}"""),
    ("ISC", f"""Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

{_AS_IS_ISC}"""),
    ("0BSD", f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

{_AS_IS_ISC}"""),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n\n{_BSD_TAIL}"),
    ("BSD-3-Clause", f"""{_BSD_HEAD}

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

{_BSD_TAIL}"""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>."""),
    *((f"{short}-{version}-or-later", f"""This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the
GNU {kind} as published by the Free Software Foundation; either version {version[0] if version.endswith("0") else version} of the License, or (at your option) any later version.

This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details.

You should have received a copy of the GNU {kind} along with this {work}{end}""")
      for short, kind, version, work, mark, end in [
          ("GPL", "General Public License", "2.0", "program", ";", _GNU_MAIL),
          ("GPL", "General Public License", "2.0", "program", ":", _GNU_WEB),
          ("LGPL", "Lesser General Public License", "2.1", "library", ";", _GNU_MAIL),
          ("LGPL", "Lesser General Public License", "2.1", "library", ":", _GNU_WEB),
          ("LGPL", "Lesser General Public License", "3.0", "program", ":", _GNU_WEB),
          ("LGPL", "Lesser General Public License", "3.0", "library", ":", _GNU_WEB),
          ("AGPL", "Affero General Public License", "3.0", "program", ":", _GNU_WEB),
      ]),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT-notice", "Released under the MIT License."),
    ("MIT-notice", "Licensed under the MIT License."),
    ("all-rights-reserved", "All rights reserved."),
    ("MIT-notice", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0-notice", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-notice", "SPDX-License-Identifier: GPL-3.0-or-later"),
]

#: Titles that stand before a text; each is optional.
TITLES: dict[str, list[str]] = {
    "MIT": ["The MIT License (MIT)", "The MIT License", "MIT License (MIT)", "MIT License"],
    "ISC": ["The ISC License", "The ISC License (ISC)", "ISC License (ISC)", "ISC License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)", "Zero-Clause BSD"],
    "BSD-2-Clause": ["The BSD 2-Clause License", "Simplified BSD License", "BSD 2-Clause License"],
    "BSD-3-Clause": ["The BSD 3-Clause License", "New BSD License", "Modified BSD License", "BSD License", "BSD 3-Clause License"],
    "Zlib": ["The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib License"],
    "Unlicense": ["Unlicense", "The Unlicense"],
}

#: Files: name, how many paragraphs at the start a text may lack, first words of what it may lack at its end.
_FILES: list[tuple[str, str, tuple[int, ...], str]] = [
    ("Apache-2.0", "Apache-2.0", (0, 1), "APPENDIX: How to apply"),
    ("MPL-2.0", "MPL-2.0", (0, 1), "Exhibit A"),
    ("CC0-1.0", "CC0-1.0", (0, 1, 2, 3), ""),
    ("GPL-2.0", "GPL-2", (0, 1, 2), "How to Apply These Terms"),
    ("GPL-3.0", "GPL-3", (0, 1, 2), "How to Apply These Terms"),
    ("LGPL-2.1", "LGPL-2.1", (0, 1, 2, 3), "How to Apply These Terms"),
    ("LGPL-3.0", "LGPL-3", (0, 1, 2), ""),
    ("Unlicense", "Unlicense", (0,), "For more information"),
]


def _whole_texts() -> list[tuple[str, str]]:
    found = []
    for name, file, heads, tail in _FILES:
        text = (files("arealis.llm") / "license_files" / f"{file}.txt").read_text("utf-8").strip()
        paragraphs = re.split(r"\n[ \t]*(?:\n[ \t]*)+", text)
        ends = [len(paragraphs)] + [k for k, p in enumerate(paragraphs) if tail and p.strip().startswith(tail)]
        found += [(name, "\n\n".join(paragraphs[a:b])) for a in heads for b in ends]
    return found


# Texts of one name with as many paragraphs must have them in the same places: the Unlicense, which may end earlier, has its
# titles in the first paragraph.
LICENSES: list[tuple[str, str]] = [
    (name, f"{title}{'\n' if name == 'Unlicense' else '\n\n'}{text}" if title else text)
    for name, text in [*_SHORT, *_whole_texts()]
    for title in ["", *TITLES.get(name, [])]
]

#: Equivalent spellings: what stands in a normalised text, and what replaces it.
SPELLINGS: list[tuple[str, str]] = [
    ("https://", "http://"), ("licence", "license"), ("sub-license", "sublicense"), ("non-infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"), ("organisation", "organization"),
    ("favour", "favor"), ("&", " and "),
]
