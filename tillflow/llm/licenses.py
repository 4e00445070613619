"""License scans: patience alignment of texts against license templates.

A template is a notice, a header or a license text with the name of its license.
Its ``must`` words have to be matched (the version, Affero, NC, ...), and none of
its ``bars`` words may stand in the matched stretch, so that the members of a
family are told apart. ``slack`` words may be missing from a short notice whatever
its length; otherwise the share ``coverage`` of the template's words is matched.

A text is scanned for regions where a template may lie: words of the template,
at most ``gap`` words apart. A match is no longer than the template's words over
``coverage``, so a region is cut into windows of that length, one from each of
its hits: a notice that the region holds several times is whole and alone in
some window. Only windows that share enough words with the template (repeats
counted) are aligned, and none that begins inside a word-for-word match. Patience alignment anchors on the words
that occur once in the region and once in the template, takes the longest
increasing subsequence of anchor pairs, and recurses into the gaps between
consecutive anchors; in a gap without unique common words, equal words at its
two ends are matched. The coverage is the share of template words that are
matched; the words of the matched stretch of text must be matched to the share
``coverage`` too, so that a longer notice is not taken for a shorter one inside it.

Of overlapping matches the one with most matched words stands; a license is
reported once per text, where most of its words are matched.

Words are runs of letters and digits, lower-cased. One scan over the texts,
no shuffle; the templates are parameters (``read_templates`` takes whole license
texts from a folder), and a text without some must word of a template is not aligned with it.

Edge cases: null or empty texts match nothing. Repeated rows get equal results.
A null doc_id is carried through. Of matches with as many words that of the
higher coverage counts, then the shorter stretch, then the first, then the license that sorts first; licenses
are reported in alphabetical order. Of an SPDX expression only an identifier that
follows the tag directly counts. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from dataclasses import dataclass
from pathlib import Path
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tillflow.llm.license_texts import CC_PARTS, GNU_HEADER, GNU_LICENSES, NOTICES, SPDX_IDS, TEXTS
from tillflow.llm.runtime import ship

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class Template(NamedTuple):
    license: str
    text: str
    must: tuple[str, ...] = ()
    bars: tuple[str, ...] = ()
    slack: int = 0


def _gnu(license_: str, kind: str, version: str) -> list[Template]:
    """The usual notices of one license of the GNU family."""
    name, short = " ".join(f"GNU {kind} General Public License".split()), license_.split("-")[0]
    bars = tuple(k for k in ("lesser", "library", "affero") if k != kind.lower())
    full = [f"This work is licensed under the {name}, version {version}", f"{name}, version {version}", f"{name} ({short}), version {version}",
            f"{name} v{version}", GNU_HEADER.format(name=name, version=version)]
    out = [Template(license_, t, tuple(words_of(f"{name} {'v' * (f' v{version}' in t)}{version}")), bars, 1) for t in full]
    return out + [Template(license_, t, tuple(words_of(t))) for t in (f"GNU {short} version {version}", f"GNU {short} v{version}")]


def _creative_commons(code: str) -> list[Template]:
    """The notices of one of the Creative Commons licenses, by its code."""
    parts = code.split("-")
    long = "Attribution" + "".join(f"-{CC_PARTS[p]}" for p in parts[1:])
    others = [p for p in CC_PARTS if p not in parts]
    short = Template(f"CC-{code}-4.0", f"Licensed under CC {code} 4.0", tuple(words_of(f"CC {code} 4.0")), tuple(p.lower() for p in others), 1)
    name = f"Creative Commons {long} 4.0 International"
    return [short, Template(short.license, f"{name} License", tuple(words_of(name)), tuple(CC_PARTS[p].lower() for p in others), 1)]


def default_templates() -> tuple[Template, ...]:
    out = [Template(name, text, tuple(must.split()), (), slack) for name, text, must, slack in NOTICES]
    for license_, kind, version in GNU_LICENSES:
        out += _gnu(license_, kind, version)
    for code in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        out += _creative_commons(code)
    out += [Template(name, f"SPDX-License-Identifier: {name}", tuple(words_of(f"spdx identifier {name}"))) for name in SPDX_IDS]
    out += [Template(name, text, tuple(must.split())) for name, text, must in TEXTS]
    return tuple(sorted(out))


def read_templates(folder: str) -> tuple[Template, ...]:
    """Whole license texts as templates, from the files of a folder the driver reads: the file's name without ending is the license."""
    files = sorted(f for f in Path(folder).iterdir() if f.is_file())
    return tuple(Template(f.stem if f.suffix in (".txt", ".md") else f.name, f.read_text(encoding="utf-8")) for f in files)


TEMPLATES = default_templates()


@dataclass(frozen=True)
class LicenseScan:
    templates: tuple[tuple, ...] = TEMPLATES
    coverage: float = 0.9
    gap: int = 6


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (ascending in the first) that ascends in the second, by patience piles."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect.bisect_left(tops, y)
        back[i] = at[k - 1] if k else -1
        if k == len(tops):
            tops.append(y)
            at.append(i)
        else:
            tops[k], at[k] = y, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment: matched positions (in a, in b), ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        place = {w: p for p, w in enumerate(b[k:m], k) if in_b[w] == 1}
        anchors = increasing([(p, place[w]) for p, w in enumerate(a[i:j], i) if in_a[w] == 1 and w in place])
        if not anchors:
            continue
        out += anchors
        edges = [(i - 1, k - 1), *anchors, (j, m)]
        todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:])]
    return sorted(out)


def standing(matches: list[tuple]) -> list[tuple]:
    """Of matches ``(..., first, license, last)``, best first, those that overlap no better one."""
    out, starts, ends = [], [], []  # the stretches that stand, in order
    for m in matches:
        lo, hi = m[-3], m[-1]
        at = bisect.bisect_right(starts, hi)
        if not at or ends[at - 1] < lo:
            starts.insert(at, lo)
            ends.insert(at, hi)
            out.append(m)
    return out


class Scanner:
    def __init__(self, p: LicenseScan):
        self.p = p
        self.templates = [t for t in (Template(*t) for t in p.templates) if words_of(t.text)]
        self.texts = [words_of(t.text) for t in self.templates]
        self.words = [frozenset(t) for t in self.texts]
        self.need = [min(-int(-len(t) * p.coverage // 1), max(len(t) - x.slack, 1)) for t, x in zip(self.texts, self.templates)]
        # of these words one must be there to match enough: the longest words that cannot all be missing
        self.some = [sorted(w, key=lambda x: (-len(x), x))[:len(t) - n + 1] for t, w, n in zip(self.texts, self.words, self.need)]

    def _able(self, low) -> list[int]:
        """Templates whose must words, and one of whose other words that cannot all be missing, are in a text or a set of words."""
        seen: dict[str, bool] = {}

        def has(w: str) -> bool:
            if w not in seen:
                seen[w] = w in low
            return seen[w]

        return [k for k, t in enumerate(self.templates) if all(map(has, t.must)) and any(map(has, self.some[k]))]

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(license, coverage, start, end in code points) of the licenses whose templates are matched, by license."""
        if not self._able(text.lower()):
            return []
        found = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        words = [text[s:e].lower() for s, e in found]
        places: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            places.setdefault(w, []).append(i)
        matches = [(-n, -n / len(self.texts[k]), hi - lo, lo, self.templates[k].license, hi)
                   for k in self._able(places) for n, lo, hi in self._matches(words, places, k)]
        out: dict[str, tuple[str, float, int, int]] = {}
        for _, share, _, lo, name, hi in standing(sorted(matches)):
            out.setdefault(name, (name, -share, found[lo][0], found[hi][1]))
        return [out[name] for name in sorted(out)]

    def _matches(self, words: list[str], places: dict[str, list[int]], k: int) -> set[tuple[int, int, int]]:
        """(matched words, first, last): what the windows of a template match; none begins inside a word-for-word match before it."""
        template, need = self.texts[k], self.need[k]
        out, free = set(), 0
        for region in self._regions(sorted(i for w in self.words[k] for i in places.get(w, ()))):
            if len(region) < need:
                continue
            for lo, hi in self._windows(words, region, template, need):
                if lo < free:
                    continue
                got = self._dense(align(words[lo:hi], template), need)
                if got and self._told(words, lo, got, k):
                    out.add((len(got), lo + got[0][0], lo + got[-1][0]))
                    if len(got) == len(template) == got[-1][0] - got[0][0] + 1:
                        free = lo + got[-1][0] + 1
        return out

    def _told(self, words: list[str], lo: int, got: list[tuple[int, int]], k: int) -> bool:
        """Whether the must words are matched and no barred word stands in the stretch."""
        t = self.templates[k]
        matched = {self.texts[k][j] for _, j in got}
        return matched.issuperset(t.must) and not (t.bars and set(t.bars).intersection(words[lo + got[0][0]:lo + got[-1][0] + 1]))

    def _dense(self, got: list[tuple[int, int]], need: int) -> list[tuple[int, int]]:
        """Matches without loose ends: the share of matched words in their stretch of text reaches the coverage too."""
        while len(got) >= need:
            if len(got) >= self.p.coverage * (got[-1][0] - got[0][0] + 1):
                return got
            if len(got) < 2:
                break
            got = got[1:] if got[1][0] - got[0][0] > got[-1][0] - got[-2][0] else got[:-1]
        return []

    def _windows(self, words: list[str], region: list[int], template: list[str], need: float):
        """(start, end) of the windows of a region that share enough words with the template, in order."""
        longest = int(len(template) / self.p.coverage + 1e-9)
        spare = Counter(template)
        shared = stop = 0
        for lo in region:
            while stop < len(region) and region[stop] < lo + longest:
                shared += spare[words[region[stop]]] > 0
                spare[words[region[stop]]] -= 1
                stop += 1
            if shared >= need:
                yield lo, region[stop - 1] + 1
            spare[words[lo]] += 1
            shared -= spare[words[lo]] > 0

    def _regions(self, hits: list[int]):
        region: list[int] = []
        for i in hits:
            if region and i - region[-1] > self.p.gap:
                yield region
                region = []
            region.append(i)
        if region:
            yield region


_SCANNERS: dict[LicenseScan, Scanner] = {}


def scan_documents(docs: DataFrame, p: LicenseScan = LicenseScan()) -> DataFrame:
    """``(doc_id, licenses, coverages, starts, ends)`` of every row; the arrays are empty where nothing is found."""
    ship(docs.sparkSession)

    def run(batches):
        if p not in _SCANNERS:
            _SCANNERS[p] = Scanner(p)
        scan = _SCANNERS[p].scan
        for batch in batches:
            found = [scan(t) if t else [] for t in batch.column("text").to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([[x[k] for x in f] for f in found], pa.list_(t)) for k, t in enumerate(kinds)]],
                ["doc_id", "licenses", "coverages", "starts", "ends"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, licenses array<string>, coverages array<double>, starts array<int>, ends array<int>")
