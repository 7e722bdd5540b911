"""Licence notices and whole licence texts, and the phrases that must stand in them."""

from __future__ import annotations

# Phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Label, wording, key phrase.
NOTICES = [
    ("gpl", "licensed under the gnu general public license version", "gnu general public license"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "you may not use this file except in compliance with the license", "except in compliance with the license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("bsd", "bsd license", "bsd license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("mpl", "mozilla public license", "mozilla public license"),
    ("cc-by", "licensed under cc by", "cc by"),
    ("cc-by", "creative commons attribution", "creative commons attribution"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("cc-by-nd", "cc by nd", "cc by nd"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
]

# Label, whole text, the phrases that must all stand in it.
TEXTS = [
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software. THE
        SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        ["sublicense and or sell copies of the software", "substantial portions of the software"],
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
        ["with or without fee is hereby granted", "disclaims all warranties with regard to this software"],
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions
        in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
        ["redistributions of source code must retain", "redistributions in binary form must reproduce"],
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will
        the authors be held liable for any damages arising from the use of this software. Permission is
        granted to anyone to use this software for any purpose, including commercial applications, and to
        alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
        software must not be misrepresented; you must not claim that you wrote the original software. If
        you use this software in a product, an acknowledgment in the product documentation would be
        appreciated but is not required. 2. Altered source versions must be plainly marked as such, and
        must not be misrepresented as being the original software. 3. This notice may not be removed or
        altered from any source distribution.""",
        ["the origin of this software must not be misrepresented", "altered source versions must be plainly marked"],
    ),
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
        ["apache license version 2 0", "governing permissions and limitations under the license"],
    ),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the
        License, or (at your option) any later version. This program is distributed in the hope that it
        will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should
        have received a copy of the GNU General Public License along with this program.""",
        ["gnu general public license as published by the free software foundation"],
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as
        a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
        ["free and unencumbered software", "commercial or non commercial and by any means"],
    ),
    (
        "boost",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of
        the software and accompanying documentation covered by this license (the "Software") to use,
        reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative
        works of the Software, and to permit third-parties to whom the Software is furnished to do so.""",
        ["execute and transmit the software", "prepare derivative works of the software"],
    ),
]
