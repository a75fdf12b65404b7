"""Wordings of licences and notices as template markup.

``[[words]]`` may be left out, ``{{n}}`` stands for one to n words; all other
words are mandatory, as scanned: lower case, without punctuation.
"""

# Published wordings.
_MIT = """
permission is hereby granted free of charge to any person obtaining a copy of this software and associated
documentation files the software to deal in the software without restriction including without limitation the rights
to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom
the software is furnished to do so subject to the following conditions the above copyright notice and this permission
notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software the
software is provided as is without warranty of any kind express or implied including but not limited to the warranties
of merchantability fitness for a particular purpose and noninfringement in no event shall the {{6}} be liable for any
claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
connection with the software or the use or other dealings in the software
"""
_BSD_GRANT = """
redistribution and use in source and binary forms with or without modification are permitted provided that the
following conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of
conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice
this list of conditions and the following disclaimer in the documentation and or other materials provided with the
distribution
"""
_BSD_NAMES = """
[[3]] neither the name of {{12}} nor the names of {{6}} may be used to endorse or promote products derived from this
software without specific prior written permission
"""
_BSD_DISCLAIMER = """
this software is provided by {{12}} as is and any express or implied warranties including but not limited to the
implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{12}} be
liable for any direct indirect incidental special exemplary or consequential damages including but not limited to
procurement of substitute goods or services loss of use data or profits or business interruption however caused and on
any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any
way out of the use of this software even if advised of the possibility of such damage
"""
_APACHE_HEADER = """
licensed under the apache license version 2 0 the license you may not use this file except in compliance with the
license you may obtain a copy of the license at [[http]] [[https]] www apache org licenses license 2 0 unless required
by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
without warranties or conditions of any kind either express or implied see the license for the specific language
governing permissions and limitations under the license
"""
_MPL_HEADER = """
this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
distributed with this file you can obtain one at [[http]] [[https]] [[www]] mozilla org mpl 2 0
"""


def _gnu_header(name: str, version: str) -> str:
    """The notice that goes with a licence of this family."""
    return f"""
this {{{{6}}}} is free software you can redistribute it and or modify it under the terms of the {name} as published by the
free software foundation either version {version} of the license or at your option any later version this {{{{6}}}} is
distributed in the hope that it will be useful but without any warranty without even the implied warranty of
merchantability or fitness for a particular purpose see the {name} for more details
[[you should have received a copy of the {name} along with this {{{{6}}}} if not see [[http]] [[https]] www gnu org licenses]]
"""


def _commons(kind: str, path: str) -> str:
    return (f"licensed under [[a]] [[the]] creative commons {kind} 4 0 [[international]] license "
            f"[[to view a copy of this license visit [[http]] [[https]] creativecommons org licenses {path} 4 0]]")


_GPL, _LGPL, _AGPL = (f"gnu {kind}general public license" for kind in ("", "lesser ", "affero "))

#: Whole wordings, and short notices that name a licence; the label is what is accepted.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license [[version]] 2 0",
    "apache-2.0-header": _APACHE_HEADER,
    "mit": "[[released]] under the [[terms of the]] mit license",
    "mit-text": _MIT,
    "bsd-2-clause-text": _BSD_GRANT + _BSD_DISCLAIMER,
    "bsd-3-clause-text": _BSD_GRANT + _BSD_NAMES + _BSD_DISCLAIMER,
    "gpl-3.0": "[[this {{3}} is]] licensed under the [[terms of the]] gnu general public license [[as published by "
               "the free software foundation]] [[either]] version 3 [[or any later version]]",
    "gpl-2.0-header": _gnu_header(_GPL, "2"),
    "gpl-3.0-header": _gnu_header(_GPL, "3"),
    "lgpl-2.1-header": _gnu_header(_LGPL, "2 1"),
    "lgpl-3.0-header": _gnu_header(_LGPL, "3"),
    "agpl-3.0-header": _gnu_header(_AGPL, "3"),
    "mpl-2.0-header": _MPL_HEADER,
    "cc-by-nc-4.0": "licensed under [[a]] [[the]] cc by nc 4 0 [[international license]]",
    "cc-by-4.0-notice": _commons("attribution", "by"),
    "cc-by-sa-4.0-notice": _commons("attribution sharealike", "by sa"),
    "cc-by-nc-4.0-notice": _commons("attribution noncommercial", "by nc"),
    "cc-by-nd-4.0-notice": _commons("attribution noderivatives", "by nd"),
    "cc0-1.0-notice": "to the extent possible under law {{12}} waived all copyright and related or neighboring rights to "
                      "{{12}}",
    "copyright-notice": "copyright [[c]] {{8}} all rights reserved",
}
