import re

import pytest

from statlake.llm.license_templates import TEMPLATES
from statlake.llm.licenses import bigrams_of, find_licenses


def brute(text, threshold=0.8):
    plain = re.sub("[^a-z0-9\n]+", " ", (text or "").lower().replace("licence", "license"))
    parts = plain.split("\n") + re.split("\n[ \n]*\n", plain) + [plain]
    out = []
    for part in dict.fromkeys(" ".join(p.split()) for p in parts):
        words = part.split()
        own = {" ".join(x) for x in zip(words, words[1:])}
        best = None
        for place, (name, template) in enumerate(TEMPLATES):
            other = set(bigrams_of(template))
            score = 2 * len(own & other) / (len(own) + len(other)) if own else 0
            if score >= threshold and (best is None or score > best[0]):
                best = (score, -place, name)
        if best:
            out.append(best)
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    mit = next(t for n, t in TEMPLATES if n == "MIT" and len(t) > 500)
    apache = next(t for n, t in TEMPLATES if n == "Apache-2.0" and len(t) > 300)
    rows = [None, "", "word", "two words", "\n\n", "Released under the MIT Licence.\nReleased under the MIT License!"]
    rows += [t for _, t in TEMPLATES]
    rows += [f"Some text.\n\n{mit}\n\nMore.\n\n{apache.replace('License', 'LICENCE')}", mit[:-200], mit[:-900]]
    rows += ["the of " * 200_000 + "\nLicensed under CC BY-NC 4.0.", "Licensed under CC BY-ND 4.0", mit + " x" * 150]
    return rows


def test_against_brute_force(spark, texts):
    rows = [(i, t, "old") for i, t in enumerate(texts)] + [(0, texts[5], "old")] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, matches string")
    got = find_licenses(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(r.text)
        assert [(round(a, 9), b, c) for a, b, c in sorted(map(tuple, r.matches))] == [
            (round(a, 9), b, c) for a, b, c in want
        ]
    assert find_licenses(frame.limit(0)).count() == 0


def test_every_template_is_found_alone(texts):
    for name, template in TEMPLATES:
        found = brute(template)
        assert found[-1][0] == 1 and found[-1][2] == name


def published(template, *cuts):
    """A template in paragraphs that begin with the given words, in lines of ten words."""
    text = " ".join(template.split())
    for cut in cuts:
        assert cut in text
        text = text.replace(cut, "\n\n" + cut, 1)
    paragraphs = [p.split() for p in text.split("\n\n")]
    return "\n\n".join(
        "\n".join(" ".join(p[i : i + 10]) for i in range(0, len(p), 10)) for p in paragraphs
    )


def test_published_layouts_inside_longer_texts(spark):
    of = lambda name, least: next(t for n, t in TEMPLATES if n == name and len(t) > least)
    notices = [
        ("MIT", published(of("MIT", 500), "The above copyright", "THE SOFTWARE IS PROVIDED")),
        ("Apache-2.0", published(of("Apache-2.0", 300), "You may obtain", "Unless required")),
        ("GPL-3.0", published(of("GPL-3.0", 300), "This program is distributed", "You should have")),
        ("BSD-2-Clause", published(of("BSD-2-Clause", 300), "1. Redis", "2. Redis", "THIS SOFTWARE IS")),
    ]
    other = [f"Section {k} says how the tool number {k} is called and what it gives back." for k in range(120)]
    rows = []
    for name, notice in notices:
        for sep in ("\n", "\n\n"):
            rows.append((name, sep.join([*other[:60], notice, *other[60:]])))
    frame = spark.createDataFrame(rows, "want string, text string")
    for r in find_licenses(frame).collect():
        assert [(m.score, m.name) for m in r.matches if m.score > 0.9] == [(1.0, r.want)]


def test_notices_of_like_licences_keep_their_names():
    of = lambda name: next(t for n, t in TEMPLATES if n == name and len(t) > 300)
    gpl = " ".join(of("GPL-3.0").split())
    lesser, affero = (gpl.replace("General Public", f"{kind} General Public") for kind in ("Lesser", "Affero"))
    neither = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    neither += "or promote products derived from this software without specific prior written permission. THIS SOFTWARE"
    third = " ".join(of("BSD-2-Clause").split()).replace("THIS SOFTWARE", neither, 1)
    cases = [("GPL-3.0", gpl), ("GPL-2.0", gpl.replace("version 3", "version 2")), ("LGPL-3.0", lesser)]
    cases += [("LGPL-2.1", lesser.replace("version 3", "version 2.1")), ("AGPL-3.0", affero), ("BSD-3-Clause", third)]
    street = "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
    cases.append(("GPL-2.0", gpl.replace("version 3", "version 2").replace("If not, see <https://www.gnu.org/licenses/>.", street)))
    for name, text in cases:
        assert [m[2] for m in brute(text)] == [name]
