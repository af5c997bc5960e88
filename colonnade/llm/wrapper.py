"""Main-text extraction by wrapper induction over the pages of a host.

A page becomes a tree of its block elements, whose leaves are runs of text. Each host has a reference page; every page of the host is
aligned with the reference by simple tree matching - nodes match if their names and classes do, and the ordered matching of their
children with the most matched nodes is taken - so nodes of different pages fall into the same slot of the reference. Siblings
alike in name and class that follow each other share a slot, which keeps the matching small: it works on kinds of siblings, not paragraphs; the
reference has one node for them, with the kinds of children that any of them has. The wrapper of a host then holds

* template texts. A text of a slot is template if ``OFTEN`` titles or more, and half of the slot's titles, have it; where the slot's other texts
  also come back (twice each or more, on average), so are those of them that ``OFTEN`` titles have, unless fewer than one title in ``RARE`` does.
  (Two titles may be two versions of one article.)
* the content slot: the innermost node whose slots hold ``MOST`` of all varying text that is no link, and of the nodes around it those
  whose other children are no frame (menus by their links, or declared by HTML);
* frame slots: what stands beside the content slot and is made of links, or has as many texts on every page and, all told, little that varies.

The text of a page is what is neither template nor frame, without elements that HTML itself declares to be something else (``nav``, ``footer``, ``aside``,
``form``, roles, ``hidden``) and without nodes whose class or id says advert, comment, notice and the like, unless the content slot lies in them. A host
with pages of a single title has no wrapper; there the ``article`` or ``main`` element, if any, and these declarations decide. Pages of one
title vote once, and a page once for a text, so that copies of an article, or lines that it repeats, do not make a template.

A wrapper - the reference and what is learnt of its slots - is bounded by pages' sizes, not by their number. Pages meet their host's in an equality join that may be split for a
host with very many pages; no task holds a host's pages.

A reference has a place for every kind of sibling, and every matching is the best one. Subtrees alike but for their texts are compared once. A node whose runs times kinds are over ``WORK`` is
matched in order where a bound shows that nothing can match more, else by whole rows of the table at a time, of which only every so many are kept.

Defined results: a null or empty html has empty text; a null or broken address belongs to the host ''; cut-off and misnested markup gives
what can be read, however deep; repeated rows give repeated results; other columns are ignored,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from hashlib import blake2b
from math import isqrt
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import markup
from .common import durable, skew_join

#: Titles that have a template text at least.
OFTEN = 3
#: Texts on fewer than one in so many of a slot's titles are never template, which bounds a wrapper.
RARE = 64
#: Share of a host's varying text that the content slot holds, and share below which a steady slot beside it is frame.
MOST, LITTLE = 0.6, 0.25
#: Runs times kinds of a node, beyond which the table of a matching is computed by rows.
WORK = 2048
#: Characters of a slot's path, beyond which a hash stands for it.
LONGEST = 200
#: What HTML itself declares to be no main text: elements and roles.
ASIDE = frozenset("head nav footer aside form script style template noscript iframe button select option textarea input menu dialog svg canvas object label fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Words of classes and ids that declare the same.
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer disqus "
    "footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification paywall popup promo promotion related replies reply share sharing "
    "sidebar social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Only outside an article: its own header holds its title.
OUTSIDE = frozenset(["header"])
LANDMARKS = frozenset(["article", "main"])
_WORD = re.compile(r"[a-z0-9]+")

# A tree is [signature, kind, children]; children are trees and texts, which are (text, characters, characters in links). Kinds:
PLAIN, LANDMARK, DECLARED, WORDED = 0, 1, 2, 3
TEXT = "#"


def host_of(url: str | None) -> str:
    try:
        return urlsplit(url or "").hostname or ""
    except ValueError:
        return ""


def kind_of(name: str, attrs: dict[str, str], inside: bool) -> int:
    """What an element says of itself; inside: whether an article or main element is open."""
    if name in ASIDE or name in OUTSIDE and not inside:
        return DECLARED
    if attrs:
        if "hidden" in attrs or attrs.get("role", "").lower() in ROLES or attrs.get("aria-hidden", "").lower() == "true":
            return DECLARED
        if name not in ("html", "body") and ("class" in attrs or "id" in attrs):
            words = set(_WORD.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()))
            if words & WORDS or not inside and words & OUTSIDE:
                return WORDED
    return LANDMARK if name in LANDMARKS else PLAIN


def block_tree(html: str) -> tuple[list, str]:
    """The page's block tree and its title (or, without one, its first heading)."""
    title = heading = ""

    def signature(node: markup.Node) -> str:
        return ".".join([node.name, *sorted(node.attrs["class"].lower().split())]) if "class" in node.attrs else node.name

    def close(tree: list, words: list[str], linked: list[int]) -> None:
        if words and (text := markup.squeeze("".join(words))):
            tree[2].append((text, len(text), min(sum(linked), len(text))))
        words.clear()
        linked.clear()

    root = ["", PLAIN, []]
    # Open blocks, each with its words since the last block, the lengths of those in links, and whether it is in a landmark; and what is left of
    # open elements, with the name of those that are blocks, and whether they are in a link.
    blocks: list[tuple[list, list[str], list[int], bool]] = [(root, [], [], False)]
    rest: list[tuple[Iterator, str | None, bool]] = [(iter(markup.parse(html).children), None, False)]
    block, raw = markup.BLOCK, markup.RAW
    while rest:
        parts, name, link = rest[-1]
        tree, words, linked, inside = blocks[-1]
        for part in parts:
            if isinstance(part, str):
                words.append(part)
                if link:
                    linked.append(len(part))
                continue
            its = part.name
            if its == "br":
                words.append(" ")
            elif its == "title" and not title:
                title = markup.squeeze("".join(x for x in part.children if isinstance(x, str)))
            elif its in block or its in ASIDE or its in LANDMARKS or part.attrs and kind_of(its, part.attrs, inside) > LANDMARK:
                close(tree, words, linked)
                kind = DECLARED if tree[1] == DECLARED else kind_of(its, part.attrs, inside)
                child = [signature(part), kind, []]
                tree[2].append(child)
                blocks.append((child, [], [], inside or its in LANDMARKS))
                rest.append((iter(part.children), its, link))
                break
            elif its not in raw:
                rest.append((iter(part.children), None, link or its == "a"))
                break
        else:
            rest.pop()
            if name is not None:
                close(tree, words, linked)
                blocks.pop()
                if name in ("h1", "h2") and not heading:
                    heading = " ".join(x[0] for x in tree[2] if isinstance(x, tuple))
    close(*blocks[0][:3])
    return root, title or heading


def number(text: str) -> str:
    """A text's hash, as 16 digits."""
    return blake2b(text.encode(), digest_size=8).hexdigest()


def runs(children: list) -> list[tuple[str, list]]:
    """Children that follow each other with one signature, together; texts have the signature TEXT."""
    out: list[tuple[str, list]] = []
    last = None
    for child in children:
        signature = child[0] if isinstance(child, list) else TEXT
        if signature == last:
            out[-1][1].append(child)
        else:
            out.append((signature, [child]))
            last = signature
    return out


class Place:
    """A node of a reference: its kinds of children, a place for each (none for texts), the slots' names, and a number that places alike in all below share."""

    __slots__ = ("declared", "kinds", "name", "of", "places", "parent", "shape", "signature", "single", "slots")

    def __init__(self, signature: str, declared: bool, name: str, parent: Place | None):
        self.signature, self.declared, self.name, self.parent = signature, declared, name, parent
        self.kinds: list[str] = []
        self.places: list[Place | None] = []
        self.slots: list[str] = []
        self.of: dict[str, list[int]] = {}
        self.single = True
        self.shape = -1

    def add(self, signature: str, kind: int) -> Place | None:
        slot = f"{self.name}/{len(self.kinds)}"
        if len(slot) > LONGEST:
            slot = f"~{number(slot)}"
        place = None if signature == TEXT else Place(signature, kind == DECLARED, slot, self)
        at = self.of.setdefault(signature, [])
        at.append(len(self.kinds))
        self.single &= len(at) == 1
        self.kinds.append(signature)
        self.places.append(place)
        self.slots.append(slot)
        return place


def reference_of(tree: list) -> Place:
    """A page's tree as a reference: no texts, and of siblings alike in signature one place with the kinds of children that any of them has."""
    root = Place(tree[0], tree[1] == DECLARED, "", None)
    rest, order = [([tree], root)], []
    while rest:
        nodes, place = rest.pop()
        order.append(place)
        groups: list[tuple[str, list]] = []
        where: dict[str, list[int]] = {}
        for node in nodes:
            at, new = 0, []
            for signature, members in runs(node[2]):
                its = where.get(signature, ())
                if (k := bisect_left(its, at)) < len(its):
                    groups[its[k]][1].extend(members)
                    at = its[k] + 1
                else:
                    new.append((at, (signature, list(members))))
            if new:
                # Each goes before the group that the node had come to.
                merged, last = [], 0
                for at, group in new:
                    merged += groups[last:at]
                    merged.append(group)
                    last = at
                groups = merged + groups[last:]
                where = {}
                for k, (signature, _) in enumerate(groups):
                    where.setdefault(signature, []).append(k)
        for signature, members in groups:
            below = place.add(signature, PLAIN if signature == TEXT else members[0][1])
            if below is not None:
                rest.append((members, below))
    numbers: dict[tuple, int] = {}
    for place in reversed(order):
        alike = tuple((k, -1 if x is None else x.shape) for k, x in zip(place.kinds, place.places, strict=True))
        place.shape = numbers.setdefault(alike, len(numbers))
    return root


class Known:
    """Sizes of the matchings of a page's nodes with places, by the shapes of both; nodes of one shape have runs of the same signatures, and of the same shapes below."""

    __slots__ = ("numbers", "shapes", "size")

    def __init__(self):
        self.shapes: dict[int, int] = {}
        self.numbers: dict[tuple, int] = {}
        self.size: dict[tuple[int, int], int] = {}

    def shape(self, node: list) -> int:
        rest = [node]
        while rest:
            x = rest[-1]
            if id(x) not in self.shapes:
                first = [(signature, members[0]) for signature, members in runs(x[2])]
                if unknown := [y for signature, y in first if signature != TEXT and id(y) not in self.shapes]:
                    rest += unknown
                    continue
                alike = tuple((signature, -1 if signature == TEXT else self.shapes[id(y)]) for signature, y in first)
                self.shapes[id(x)] = self.numbers.setdefault(alike, len(self.numbers))
            rest.pop()
        return self.shapes[id(node)]


def in_order(a: list[tuple[str, list]], place: Place) -> list[tuple[int, int]]:
    """Each run with the next kind of its signature, in order."""
    pairs, at = [], 0
    for i, (signature, _) in enumerate(a):
        where = place.of.get(signature)
        if where and (k := bisect_left(where, at)) < len(where):
            pairs.append((i, where[k]))
            at = where[k] + 1
    return pairs


def plain_pairs(a: list[tuple[str, list]], place: Place) -> list[tuple[int, int]] | None:
    """The one best matching where no signature comes twice on either side and the common ones stand in the same order, else None."""
    if not place.single or len({s for s, _ in a}) < len(a):
        return None
    pairs = [(i, where[0]) for i, (s, _) in enumerate(a) if (where := place.of.get(s))]
    return pairs if all(x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False)) else None


def row_after(above: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """The next row of the table of a matching; gain: what the run matches with each kind."""
    row = np.zeros_like(above)
    np.maximum.accumulate(np.maximum(above[1:], above[:-1] + gain), out=row[1:])
    return row


def paired(a: list[tuple[str, list]], place: Place, known: Known) -> tuple[int, list[tuple[int, int]]]:
    """Most nodes matched below, and the runs and kinds that go together; ``known`` has the sizes of the pairs of nodes."""

    def size(i: int, j: int) -> int:
        below = place.places[j]
        return 1 if below is None else known.size[known.shape(a[i][1][0]), below.shape]

    pairs = plain_pairs(a, place)
    if pairs is not None:
        return sum(size(i, j) for i, j in pairs), pairs
    if len(a) * len(place.kinds) > WORK:
        return paired_by_rows(a, place, size, known)
    b = place.kinds
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, (signature, _) in enumerate(a):
        row, above = best[i + 1], best[i]
        for j, other in enumerate(b):
            most = max(above[j + 1], row[j])
            if signature == other:
                most = max(most, above[j] + size(i, j))
            row[j + 1] = most
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1][0] == b[j - 1] and best[i][j] == best[i - 1][j - 1] + size(i - 1, j - 1):
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[-1][-1], pairs[::-1]


def paired_by_rows(a: list[tuple[str, list]], place: Place, size: Callable[[int, int], int], known: Known) -> tuple[int, list[tuple[int, int]]]:
    """The same for many runs and kinds."""
    b = len(place.kinds)
    a_of = [(i, (signature, -1 if signature == TEXT else known.shape(members[0]))) for i, (signature, members) in enumerate(a) if signature in place.of]
    gains: dict[tuple[str, int], np.ndarray] = {}

    def gain(k: int) -> np.ndarray:
        i, alike = a_of[k]
        if alike not in gains:
            if len(gains) * b > 1 << 22:
                gains.clear()
            gains[alike] = np.zeros(b, np.int32)
            gains[alike][place.of[alike[0]]] = [size(i, j) for j in place.of[alike[0]]]
        return gains[alike]

    # No matching has more than each run's best, nor than each kind's.
    by_run, by_kind, tops = 0, np.zeros(b, np.int32), {}
    for k, (_, alike) in enumerate(a_of):
        if alike not in tops:
            tops[alike] = int(gain(k).max())
            np.maximum(by_kind, gain(k), out=by_kind)
        by_run += tops[alike]
    pairs = in_order(a, place)
    total = sum(size(i, j) for i, j in pairs)
    if total == min(by_run, int(by_kind.sum())):
        return total, pairs
    # Every so many rows are kept; those between are computed again on the way back.
    step = isqrt(len(a_of)) + 1
    row = np.zeros(b + 1, np.int32)
    kept = [row]
    for k in range(len(a_of)):
        row = row_after(row, gain(k))
        if (k + 1) % step == 0:
            kept.append(row)
    total, pairs, i, j = int(row[-1]), [], len(a_of), b
    while i and j:
        first = (i - 1) // step * step
        rows = [kept[first // step]]
        for k in range(first, i):
            rows.append(row_after(rows[-1], gain(k)))
        while i > first and j:
            here, above, its = rows[i - first], rows[i - first - 1], gain(i - 1)
            if its[j - 1] and here[j] == above[j - 1] + its[j - 1]:
                i, j = i - 1, j - 1
                pairs.append((a_of[i][0], j))
            elif here[j] == above[j]:
                i -= 1
            else:
                j -= 1
    return total, pairs[::-1]


def match(mine: list, place: Place, known: Known | None = None) -> tuple[int, list[tuple[int, int]]]:
    """Nodes that simple tree matching matches in a tree and a place of one signature, and which runs go with which kinds of children."""
    known = Known() if known is None else known
    rest = [(mine, place)]
    while rest:
        x, y = rest[-1]
        key = known.shape(x), y.shape
        if key in known.size and len(rest) > 1:
            rest.pop()
            continue
        a = runs(x[2])
        pairs = plain_pairs(a, y)
        if pairs is not None:
            below = [(a[i][1][0], y.places[j]) for i, j in pairs if y.places[j] is not None]
        else:
            nodes = {(signature, known.shape(members[0])): members[0] for signature, members in a if signature != TEXT and signature in y.of}
            places = {signature: {y.places[j].shape: y.places[j] for j in y.of[signature]} for signature, _ in nodes}
            below = [(node, its) for (signature, _), node in nodes.items() for its in places[signature].values()]
        if unknown := [(node, its) for node, its in below if (known.shape(node), its.shape) not in known.size]:
            rest += unknown
            continue
        rest.pop()
        answer = paired(a, y, known)
        known.size[key] = 1 + answer[0]
    return 1 + answer[0], answer[1]


def aligned(mine: list, reference: Place | None) -> Iterator[tuple[str | None, tuple[str | None, ...], object]]:
    """For tests: the slot of each text in page order (None where the reference has none), and the text."""
    rest: list[tuple] = [(mine, reference if reference is not None and mine[0] == reference.signature else None)]
    known = Known()
    while rest:
        node, place = rest.pop()
        if isinstance(node, tuple):
            yield place, node
            continue
        parts = []
        for members, slot, below in slots_of(node, place, known):
            parts += [(child, slot if isinstance(child, tuple) else below) for child in members]
        rest.extend(reversed(parts))


def slots_of(node: list, place: Place | None, known: Known) -> list[tuple[list, str | None, Place | None]]:
    """The runs of a node's children, each with its slot's name and place (None: none)."""
    a = runs(node[2])
    if place is None:
        return [(members, None, None) for _, members in a]
    pairs = plain_pairs(a, place)
    to = dict(match(node, place, known)[1] if pairs is None else pairs)
    return [(members, None, None) if (j := to.get(i)) is None else (members, place.slots[j], place.places[j]) for i, (_, members) in enumerate(a)]


class Wrapper:
    """What is learnt of a host: its reference, template texts, frame slots, and the slots that hold the content."""

    __slots__ = ("content", "frame", "reference", "template")

    def __init__(self, reference: Place | None = None, template: frozenset[str] = frozenset(), frame: frozenset[str] = frozenset(), content: frozenset[str] = frozenset()):
        self.reference, self.template, self.frame, self.content = reference, template, frame, content


def entry(slot: str, text: str) -> str:
    """How a template names a text of a slot."""
    return f"{slot} {text}"


class Slot:
    """Sums over a slot and all below it, over the titles of a host: characters, those in links, and those of varying text; whether each title has as many texts."""

    __slots__ = ("chars", "links", "mass", "steady")

    def __init__(self, chars: int = 0, links: int = 0, constant: int = 0, steady: bool = True):
        self.chars, self.links, self.mass, self.steady = chars, links, max(chars - links - constant, 0), steady

    def add(self, other: Slot) -> None:
        self.chars, self.links, self.mass, self.steady = self.chars + other.chars, self.links + other.links, self.mass + other.mass, self.steady and other.steady

    @property
    def linked(self) -> bool:
        return self.chars > 0 and 2 * self.links >= self.chars


def judged(root: Place, seen: dict[str, tuple[int, int, bool]], constant: dict[str, int], declared: bool = True) -> tuple[frozenset[str], frozenset[str]]:
    """The frame slots and those that hold the content. seen: characters, those in links and steadiness of the slots of texts; constant: characters of template texts."""
    order, sums = [root], {}
    for place in order:
        order += [x for x in place.places if x is not None]
    for place in reversed(order):
        own = sums[id(place)] = Slot()
        if not (declared and place.declared):
            for slot, below in zip(place.slots, place.places, strict=True):
                own.add(sums[id(below)] if below is not None else Slot(*seen.get(slot, (0, 0, True))[:2], constant.get(slot, 0), seen.get(slot, (0, 0, True))[2]))
    total = sums[id(root)].mass
    if not total:
        return frozenset(), frozenset()
    core = root
    while inner := next((x for x in core.places if x is not None and any(x.places) and sums[id(x)].mass >= MOST * total), None):
        core = inner

    def beside(place: Place) -> Iterator[tuple[str, Place | None, Slot]]:
        for slot, x in zip(place.parent.slots, place.parent.places, strict=True):
            if x is not place:
                yield slot, x, sums[id(x)] if x is not None else Slot(*seen.get(slot, (0, 0, True))[:2], constant.get(slot, 0), seen.get(slot, (0, 0, True))[2])

    content = {core.name}
    while core.parent is not None and not any(x is not None and (declared and x.declared or s.linked) for _, x, s in beside(core)):
        core = core.parent
        content.add(core.name)
    frame = set()
    while core.parent is not None:
        frame |= {slot for slot, _, s in beside(core) if s.linked or s.steady and s.mass < LITTLE * total}
        core = core.parent
        content.add(core.name)
    return frozenset(frame), frozenset(content)


def main_text(tree: list, wrapper: Wrapper, declared: bool = True) -> tuple[str, int]:
    """The main text, and how many blocks the wrapper took out. ``declared``: whether what pages declare counts."""
    kept, landed, no, taken = [], [], [], 0
    reference = wrapper.reference if wrapper.reference is not None and wrapper.reference.signature == tree[0] else None
    template, frame, content = wrapper.template, wrapper.frame, wrapper.content
    known = Known()
    rest: list[tuple] = [(tree, reference, None, False, False)]
    while rest:
        node, place, slot, out, inside = rest.pop()
        if isinstance(node, tuple):
            text = node[0]
            if out or slot is not None and (slot in frame or template and entry(slot, number(text)) in template):
                taken += 1
                no.append((text, inside))
            else:
                kept.append(text)
                landed.append(inside)
            continue
        if declared and (node[1] == DECLARED or node[1] == WORDED and (slot is None or slot not in content) and not (out or slot in frame)):
            continue
        out = out or slot is not None and slot in frame
        inside = inside or declared and node[1] == LANDMARK
        parts = []
        for members, its, below in slots_of(node, place, known):
            parts += [(child, below, its, out, inside) for child in members]
        rest.extend(reversed(parts))
    if reference is None or not content:
        # Nothing is known of the host's slots: the landmark decides, if the page has one.
        if any(landed):
            kept = [x for x, y in zip(kept, landed, strict=True) if y]
    if not kept:
        kept = [x for x, y in no if y]
        taken -= len(kept)
    return "\n\n".join(kept), taken


def flat(tree: list) -> list:
    """A tree as one list: [signature, kind] where a node begins, None where it ends, and texts, each as three items."""
    out: list = []
    rest: list = [tree]
    while rest:
        part = rest.pop()
        if isinstance(part, list):
            out.append(part[:2])
            rest.append(None)
            rest += part[2][::-1]
        elif part is None:
            out.append(None)
        else:
            out += part
    return out


def deep(parts: list) -> list:
    """The tree of such a list."""
    top: list = ["", PLAIN, []]
    open_nodes = [top]
    items = iter(parts)
    for part in items:
        if part is None:
            open_nodes.pop()
        elif isinstance(part, list):
            part.append([])
            open_nodes[-1][2].append(part)
            open_nodes.append(part)
        else:
            open_nodes[-1][2].append((part, next(items), next(items)))
    return top[2][0]


def skeleton(parts: list) -> list:
    """A tree, as one list, with numbers for its texts."""
    return [number(x) if isinstance(x, str) else x for x in parts]


def slim(tree: list) -> list:
    """A tree, as one list, without the insides of what is declared."""
    out: list = []
    rest: list = [tree]
    while rest:
        part = rest.pop()
        if isinstance(part, list):
            out.append(part[:2])
            rest.append(None)
            if part[1] != DECLARED:
                rest += part[2][::-1]
        elif part is None:
            out.append(None)
        else:
            out += part
    return out


def pack(value: object) -> bytes:
    return zlib.compress(json.dumps(value, ensure_ascii=False, separators=(",", ":")).encode(), 1)


def unpack(data: bytes) -> object:
    return json.loads(zlib.decompress(data))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)


def wrappers(pages: DataFrame, declared: bool = True) -> DataFrame:
    """host and wrapper (packed) of every host of ``pages`` (page_id, url, html) that has pages of two titles or more."""
    shown = slim if declared else flat

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tree, title = block_tree(html or "")
                packed = pack(skeleton(shown(tree)))
                rows.append((host_of(url), number(title or packed.hex()), packed))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.binary()), strict=True)], names=["host", "vote", "tree"])

    # One page of each title, whichever hashes lowest, so the choice is the same each time.
    read_pages = pages.select("url", "html").mapInArrow(read, "host string, vote string, tree binary")
    votes = durable(read_pages.groupBy("host", "vote").agg(F.min("tree").alias("tree")))
    reference = votes.groupBy("host").agg(F.min_by("tree", F.xxhash64("vote", "tree")).alias("reference"), F.count("*").alias("titles")).where("titles > 1")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place = None, None
        for batch in _slices(batches):
            hosts, slots, texts, sums, links, numbers = [], [], [], [], [], []
            for host, tree, packed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if packed != last:
                    last, place = packed, reference_of(deep(unpack(packed)))
                found: dict[str, dict[str, int]] = {}
                size: dict[str, list[int]] = {}
                for slot, (text, chars, linked) in aligned(deep(unpack(tree)), place):
                    if slot is not None:
                        found.setdefault(slot, {})[text] = chars
                        own = size.setdefault(slot, [0, 0, 0])
                        own[0] += chars
                        own[1] += linked
                        own[2] += 1
                for slot, its in found.items():
                    slots += [slot] * (1 + len(its))
                    texts += [None, *its]
                    sums += [size[slot][0], *its.values()]
                    links += [size[slot][1]] + [0] * len(its)
                    numbers += [size[slot][2]] + [0] * len(its)
                hosts += [host] * (len(slots) - len(hosts))
            columns = [(hosts, pa.string()), (slots, pa.string()), (texts, pa.string()), (sums, pa.int64()), (links, pa.int64()), (numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in columns], names=["host", "slot", "text", "chars", "links", "n"])

    seen = skew_join(votes, reference, "host").select("host", "tree", "reference").mapInArrow(count, "host string, slot string, text string, chars long, links long, n long")
    texts = seen.groupBy("host", "slot", "text").agg(
        F.count("*").alias("k"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.min("n").alias("fewest"), F.max("n").alias("most_n"), F.max(F.col("text").isNotNull()).alias("told")
    )
    # The row without a text counts the titles that have the slot. It is told by an aggregate, since a filter on the text itself
    # would be pushed below, and the pages matched twice.
    told, whole = F.col("told"), lambda c: F.sum(F.when(~F.col("told"), F.col(c))).alias(c)
    slots_seen = durable(
        texts.groupBy("host", "slot").agg(
            F.sum(F.when(~told, F.col("k"))).alias("titles"), F.sum(F.when(told, F.col("k"))).alias("k_all"), F.count("text").alias("d_all"), whole("chars"), whole("links"), whole("fewest"), whole("most_n"),
        )
    )
    often = texts.where(told & (F.col("k") >= OFTEN)).select(F.struct("host", "slot").alias("key"), "host", "slot", "text", "k", F.col("chars").alias("size"))
    again = skew_join(often, slots_seen.select(F.struct("host", "slot").alias("key"), "titles", "k_all", "d_all"), "key")
    again = durable(again.withColumn("most", F.col("k") * 2 >= F.col("titles")).where(f"k * {RARE} >= titles"))
    rest = again.groupBy("key").agg(F.sum(F.when(F.col("most"), F.col("k")).otherwise(0)).alias("k_most"), F.sum(F.col("most").cast("long")).alias("d_most"))
    constant = skew_join(again, rest, "key").where("most OR 2 * (d_all - d_most) <= k_all - k_most")
    # Bounded by RARE times the texts of a page, as each text is on that share of the titles; and slots are those of one reference.
    template = constant.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", "text", "size"))).alias("template"))
    slots = slots_seen.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", "chars", "links", (F.col("fewest") == F.col("most_n")).alias("steady")))).alias("slots"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 16):
            out = []
            for packed, texts, slots in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                constant: dict[str, int] = {}
                for x in texts or ():
                    constant[x["slot"]] = constant.get(x["slot"], 0) + x["size"]
                tree = unpack(packed)
                frame, content = judged(reference_of(deep(unpack(packed))), {x["slot"]: (x["chars"], x["links"], x["steady"]) for x in slots or ()}, constant, declared)
                out.append(pack([tree, [entry(x["slot"], x["text"]) for x in texts or ()], sorted(frame), sorted(content)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["host", "wrapper"])

    known = reference.select("host", "reference").join(template, "host", "left").join(slots, "host", "left")
    return known.select("host", "reference", "template", "slots").mapInArrow(learn, "host string, wrapper binary")


def unpacked(packed: bytes | None) -> Wrapper:
    if packed is None:
        return Wrapper()
    tree, template, frame, content = unpack(packed)
    return Wrapper(reference_of(deep(tree)), *map(frozenset, (template, frame, content)))


def main_texts(pages: DataFrame, declared: bool = True) -> DataFrame:
    """page_id, url, text, n_chars and n_template (blocks that the wrapper took out) of every page. ``declared``: whether elements, roles, classes and landmarks count;
    without, the wrapper alone decides."""
    shown = slim if declared else flat

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            hosts = [host_of(u) for u in batch.column(1).to_pylist()]
            trees = [pack(shown(block_tree(h or "")[0])) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hosts), pa.array(trees, pa.binary())], names=["page_id", "url", "host", "tree"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes | None, Wrapper] = {}
        for batch in _slices(batches):
            out = []
            for tree, packed in zip(*(batch.column(i).to_pylist() for i in (2, 3)), strict=True):
                if packed not in held:
                    if len(held) > 32:
                        held.clear()
                    held[packed] = unpacked(packed)
                out.append(main_text(deep(unpack(tree)), held[packed], declared))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t for t, _ in out], pa.string()), pa.array([len(t) for t, _ in out], pa.int64()), pa.array([n for _, n in out], pa.int32())],
                names=["page_id", "url", "text", "n_chars", "n_template"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(read, "page_id long, url string, host string, tree binary")
    both = skew_join(rows, wrappers(pages, declared), "host", "left").select("page_id", "url", "tree", "wrapper")
    return both.mapInArrow(extract, "page_id long, url string, text string, n_chars long, n_template int")
