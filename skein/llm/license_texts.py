"""Known licence texts and notices, and spellings that count as equal.

Fixed values: public licence texts, and notices that stand for a licence.
"""

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_0BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""

_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

_GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""

#: (license_id, text). Several texts may stand for one licence.
KNOWN = [
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", _MIT),
    ("ISC", "ISC License\n\n" + _ISC),
    ("ISC", _ISC),
    ("0BSD", "BSD Zero Clause License\n\n" + _0BSD),
    ("0BSD", _0BSD),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Apache-2.0", _APACHE_HEADER),
    ("GPL-3.0-or-later", _GPL_NOTICE),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]

#: Spellings that count as equal, after punctuation became spaces.
SPELLINGS = [
    ("licence", "license"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("colour", "color"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("judgement", "judgment"),
    ("labelled", "labeled"),
    ("labour", "labor"),
    ("modelled", "modeled"),
    ("offence", "offense"),
    ("programme ", "program "),
    ("practise", "practice"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("copyright owner", "copyright holder"),
    ("per cent", "percent"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

#: (license_id, SHA-256 of the canonical form, its characters) of long licences, by their entire texts as
#: operating systems ship them. The canonical form is that of ``license_scan``; a change there needs new digests.
DIGESTS = [
    ("Apache-2.0", "d2178e92cbb87e459107d02d99e9c6827b24e011439438cbe52883b73891bd5d", 9706),
    ("Artistic-1.0-Perl", "7f6863721cbad28fddd745316da078e38412ab995636d0df06ea0237759bfb2c", 5683),
    ("CC0-1.0", "8a58796fb749d87126983cebc26e6619b99601332e2fee24acbad509518cad3f", 6692),
    ("GFDL-1.2", "50516456b02d21f3eddc795284661170883e70f6d17ae784f9179cae739d38b7", 19510),
    ("GFDL-1.3", "5088e9395e3dcb3233d7f0bb02cbbb2fbe4a5065ec192be935776131bb442272", 21879),
    ("GPL-1.0-only", "b6f369bdd84e6de75aa454489b778914b3d31b942699818c08c8b6b8e362011e", 11765),
    ("GPL-2.0-only", "28275dd192e4e55f2fcae452e90ec3ebe58eed4ee36b3c38a62a89920f0ec3be", 17053),
    ("GPL-3.0-only", "1b0b0d7dbac76d952315890d85414673e9adaab0688350940e4ff4ddd3a542d0", 33277),
    ("LGPL-2.0-only", "e5df50b6f8ed705412d661476dd4dfbce14c85659dd45bea6f08ff618b7070bc", 23937),
    ("LGPL-2.1-only", "89a8c43c15449e078893f13da81066858babb66cf2ee35756e9429b1c1279c97", 25024),
    ("LGPL-3.0-only", "9111884d93a72b30a3d024876dab3d755949ac2cfab230268a4169a93b86560c", 7104),
    ("MPL-1.1", "05f9edf363f16ae3f8cc9aeff1e9dfd9aa993ecaf65a0fcf18263c51a272543a", 22340),
    ("MPL-2.0", "88b06c62211af6dc8c37d9eece56c91b643d4359669fbd9f658f1945205c47bb", 14272),
]
