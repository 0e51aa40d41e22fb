"""Notices of well-known licenses and paragraphs of their bodies, as templates for scans.

Fixed values, keyed by license and part. Bodies of MIT, BSD and ISC are whole; of the long
licenses these are the notices and the paragraphs that are quoted most.
"""

TEXTS = {
    "Apache-2.0-notice-end": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied. See the License for the specific language governing permissions and limitations under the "
        "License."
    ),
    "Apache-2.0-copyright-grant": (
        "2. Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor "
        "hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable "
        "copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, "
        "sublicense, and distribute the Work and such Derivative Works in Source or Object form."
    ),
    "Apache-2.0-patent-grant": (
        "3. Grant of Patent License. Subject to the terms and conditions of this License, each Contributor "
        "hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable "
        "(except as stated in this section) patent license to make, have made, use, offer to sell, sell, "
        "import, and otherwise transfer the Work, where such license applies only to those patent claims "
        "licensable by such Contributor that are necessarily infringed by their Contribution(s) alone or by "
        "combination of their Contribution(s) with the Work to which such Contribution(s) was submitted. If "
        "You institute patent litigation against any entity (including a cross-claim or counterclaim in a "
        "lawsuit) alleging that the Work or a Contribution incorporated within the Work constitutes direct or "
        "contributory patent infringement, then any patent licenses granted to You under this License for "
        "that Work shall terminate as of the date such litigation is filed."
    ),
    "Apache-2.0-redistribution": (
        "4. Redistribution. You may reproduce and distribute copies of the Work or Derivative Works thereof "
        "in any medium, with or without modifications, and in Source or Object form, provided that You meet "
        "the following conditions: (a) You must give any other recipients of the Work or Derivative Works a "
        "copy of this License; and (b) You must cause any modified files to carry prominent notices stating "
        "that You changed the files; and (c) You must retain, in the Source form of any Derivative Works that "
        "You distribute, all copyright, patent, trademark, and attribution notices from the Source form of "
        "the Work, excluding those notices that do not pertain to any part of the Derivative Works; and (d) "
        'If the Work includes a "NOTICE" text file as part of its distribution, then any Derivative Works '
        "that You distribute must include a readable copy of the attribution notices contained within such "
        "NOTICE file, excluding those notices that do not pertain to any part of the Derivative Works, in at "
        "least one of the following places: within a NOTICE text file distributed as part of the Derivative "
        "Works; within the Source form or documentation, if provided along with the Derivative Works; or, "
        "within a display generated by the Derivative Works, if and wherever such third-party notices "
        "normally appear. The contents of the NOTICE file are for informational purposes only and do not "
        "modify the License. You may add Your own attribution notices within Derivative Works that You "
        "distribute, alongside or as an addendum to the NOTICE text from the Work, provided that such "
        "additional attribution notices cannot be construed as modifying the License. You may add Your own "
        "copyright statement to Your modifications and may provide additional or different license terms and "
        "conditions for use, reproduction, or distribution of Your modifications, or for any such Derivative "
        "Works as a whole, provided Your use, reproduction, and distribution of the Work otherwise complies "
        "with the conditions stated in this License."
    ),
    "Apache-2.0-warranty": (
        "7. Disclaimer of Warranty. Unless required by applicable law or agreed to in writing, Licensor "
        'provides the Work (and each Contributor provides its Contributions) on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied, including, without limitation, any "
        "warranties or conditions of TITLE, NON-INFRINGEMENT, MERCHANTABILITY, or FITNESS FOR A PARTICULAR "
        "PURPOSE. You are solely responsible for determining the appropriateness of using or redistributing "
        "the Work and assume any risks associated with Your exercise of permissions under this License."
    ),
    "Apache-2.0-liability": (
        "8. Limitation of Liability. In no event and under no legal theory, whether in tort (including "
        "negligence), contract, or otherwise, unless required by applicable law (such as deliberate and "
        "grossly negligent acts) or agreed to in writing, shall any Contributor be liable to You for damages, "
        "including any direct, indirect, special, incidental, or consequential damages of any character "
        "arising as a result of this License or out of the use or inability to use the Work (including but "
        "not limited to damages for loss of goodwill, work stoppage, computer failure or malfunction, or any "
        "and all other commercial damages or losses), even if such Contributor has been advised of the "
        "possibility of such damages."
    ),
    "BSD-conditions": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution."
    ),
    "BSD-3-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "BSD-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
        "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
        "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
        "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "MIT-rights": (
        "to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions"
    ),
    "MIT-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "MIT-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies."
    ),
    "ISC-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Unlicense-dedication": (
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any "
        "and all copyright interest in the software to the public domain. We make this dedication for the "
        "benefit of the public at large and to the detriment of our heirs and successors. We intend this "
        "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        "this software under copyright law."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is granted "
        "to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely"
    ),
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "LGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version."
    ),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
        "the License, or (at your option) any later version."
    ),
    "GPL-warranty": (
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
    "LGPL-warranty": (
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General "
        "Public License for more details."
    ),
    "AGPL-warranty": (
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General "
        "Public License for more details."
    ),
    "GPL-3.0-preamble": (
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. "
        "The licenses for most software and other practical works are designed to take away your freedom to "
        "share and change the works. By contrast, the GNU General Public License is intended to guarantee "
        "your freedom to share and change all versions of a program--to make sure it remains free software "
        "for all its users. We, the Free Software Foundation, use the GNU General Public License for most of "
        "our software; it applies also to any other work released this way by its authors. You can apply it "
        "to your programs, too."
    ),
    "GPL-2.0-preamble": (
        "The licenses for most software are designed to take away your freedom to share and change it. By "
        "contrast, the GNU General Public License is intended to guarantee your freedom to share and change "
        "free software--to make sure the software is free for all its users. This General Public License "
        "applies to most of the Free Software Foundation's software and to any other program whose authors "
        "commit to using it. (Some other Free Software Foundation software is covered by the GNU Lesser "
        "General Public License instead.) You can apply it to your programs, too."
    ),
    "LGPL-2.1-preamble": (
        "The licenses for most software are designed to take away your freedom to share and change it. By "
        "contrast, the GNU General Public Licenses are intended to guarantee your freedom to share and change "
        "free software--to make sure the software is free for all its users. This license, the Lesser General "
        "Public License, applies to some specially designated software packages--typically libraries--of the "
        "Free Software Foundation and other authors who decide to use it. You can use it too, but we suggest "
        "you first think carefully about whether this license or the ordinary General Public License is the "
        "better strategy to use in any particular case, based on the explanations below."
    ),
    "GPL-3.0-verbatim-copies": (
        "You may convey verbatim copies of the Program's source code as you receive it, in any medium, "
        "provided that you conspicuously and appropriately publish on each copy an appropriate copyright "
        "notice; keep intact all notices stating that this License and any non-permissive terms added in "
        "accord with section 7 apply to the code; keep intact all notices of the absence of any warranty; and "
        "give all recipients a copy of this License along with the Program."
    ),
    "GPL-3.0-disclaimer": (
        "THERE IS NO WARRANTY FOR THE PROGRAM, TO THE EXTENT PERMITTED BY APPLICABLE LAW. EXCEPT WHEN "
        'OTHERWISE STATED IN WRITING THE COPYRIGHT HOLDERS AND/OR OTHER PARTIES PROVIDE THE PROGRAM "AS IS" '
        "WITHOUT WARRANTY OF ANY KIND, EITHER EXPRESSED OR IMPLIED, INCLUDING, BUT NOT LIMITED TO, THE "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE. THE ENTIRE RISK AS TO "
        "THE QUALITY AND PERFORMANCE OF THE PROGRAM IS WITH YOU. SHOULD THE PROGRAM PROVE DEFECTIVE, YOU "
        "ASSUME THE COST OF ALL NECESSARY SERVICING, REPAIR OR CORRECTION. 16. Limitation of Liability. IN NO "
        "EVENT UNLESS REQUIRED BY APPLICABLE LAW OR AGREED TO IN WRITING WILL ANY COPYRIGHT HOLDER, OR ANY "
        "OTHER PARTY WHO MODIFIES AND/OR CONVEYS THE PROGRAM AS PERMITTED ABOVE, BE LIABLE TO YOU FOR "
        "DAMAGES, INCLUDING ANY GENERAL, SPECIAL, INCIDENTAL OR CONSEQUENTIAL DAMAGES ARISING OUT OF THE USE "
        "OR INABILITY TO USE THE PROGRAM (INCLUDING BUT NOT LIMITED TO LOSS OF DATA OR DATA BEING RENDERED "
        "INACCURATE OR LOSSES SUSTAINED BY YOU OR THIRD PARTIES OR A FAILURE OF THE PROGRAM TO OPERATE WITH "
        "ANY OTHER PROGRAMS), EVEN IF SUCH HOLDER OR OTHER PARTY HAS BEEN ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGES."
    ),
    "MPL-2.0-file": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
    "MPL-2.0-grants": (
        "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license: (a) under "
        "intellectual property rights (other than patent or trademark) Licensable by such Contributor to use, "
        "reproduce, make available, modify, display, perform, distribute, and otherwise exploit its "
        "Contributions, either on an unmodified basis, with Modifications, or as part of a Larger Work; and "
        "(b) under Patent Claims of such Contributor to make, use, sell, offer for sale, have made, import, "
        "and otherwise transfer either its Contributions or its Contributor Version."
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at"
    ),
    "EPL-1.0": (
        "All rights reserved. This program and the accompanying materials are made available under the terms "
        "of the Eclipse Public License v1.0 which accompanies this distribution, and is available at"
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "CC-BY-NC-4.0-work": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC0-1.0-purpose": (
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and "
        'Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an "owner") '
        'of an original work of authorship and/or a database (each, a "Work").'
    ),
}
