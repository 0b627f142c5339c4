"""Licence texts and their standard headers, by SPDX identifier.

The texts of the folder ``license_files`` are whole licences. Creative Commons and AGPL have no text there: they are known
by the titles and notices below.
"""

from __future__ import annotations

from pathlib import Path

_FOLDER = Path(__file__).with_name("license_files")

_GNU = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name}"
    " as published by the Free Software Foundation; either version {version} of the License, or (at your option)"
    " any later version."
)
_GNU_ONLY = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name}"
    " version {version} as published by the Free Software Foundation."
)
_GPL, _LESSER = "General Public License", "Lesser General Public License"
_AFFERO = "Affero General Public License"
_CREATIVE = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}


def _gnu(what: str, name: str, version: str) -> list[str]:
    return [t.format(what=what, name=name, version=version) for t in (_GNU, _GNU_ONLY)]


# Headers as the licences tell to write them, and titles that stand above a licence.
HEADERS = {
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        ' software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS'
        " OF ANY KIND, either express or implied. See the License for the specific language governing permissions"
        " and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ],
    "GPL-2.0": [*_gnu("program", _GPL, "2"), "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": [*_gnu("program", _GPL, "3"), "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.1": [*_gnu("library", _LESSER, "2.1"), "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": [*_gnu("library", _LESSER, "3"), "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0": [*_gnu("program", _AFFERO, "3"), "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
        " was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0",
    ],
    **{
        f"CC-{short}-4.0": [
            f"This work is licensed under a Creative Commons {title} 4.0 International License.",
            f"Creative Commons {title} 4.0 International Public License",
        ]
        for short, title in _CREATIVE.items()
    },
}


def block_templates() -> dict[str, str]:
    """Texts and headers, by licence and number: ``GPL-2.0#0``."""
    texts = {p.stem: [p.read_text(encoding="utf-8")] for p in sorted(_FOLDER.glob("*.txt"))}
    names = sorted({*texts, *HEADERS})
    return {
        f"{name}#{i}": text
        for name in names
        for i, text in enumerate(texts.get(name, []) + HEADERS.get(name, []))
    }
