"""K-mer sets that tell a locus' templates from its wild type and from each other; a few dozen, on the driver."""

from __future__ import annotations

from ampliscope.operators.align import reverse_complement


def over(sequence: str, positions: list[int], k: int) -> set[str]:
    """K-mers over any of the positions, and their reverse complements."""
    s = sequence.upper()
    own = {s[i : i + k] for p in positions for i in range(max(0, p - k + 1), min(p, len(s) - k) + 1)}
    return own | {reverse_complement(x) for x in own}


def every(sequence: str, k: int) -> set[str]:
    s = sequence.upper()
    own = {s[i : i + k] for i in range(len(s) - k + 1)}
    return own | {reverse_complement(x) for x in own}


def edit_sets(reference: str, template: str, positions: list[int], k: int = 12) -> tuple[set[str], set[str]]:
    """(wild-type, HDR) k-mers over the edits, without those that both sequences have."""
    wt, hdr = over(reference, positions, k), over(template, positions, k)
    return wt - every(template, k), hdr - every(reference, k)


def template_sets(reference: str, templates: dict[str, str], positions: dict[str, list[int]], k: int = 12, most: int = 40) -> tuple[int, dict[str, set[str]]]:
    """K-mers that only one template has, with k raised by 2 until each has some or `most` is reached."""
    while True:
        wt = every(reference, k)
        own = {name: over(t, positions[name], k) - wt for name, t in templates.items()}
        alone = {name: s - set().union(*(o for other, o in own.items() if other != name)) for name, s in own.items()}
        if all(alone.values()) or k >= most:
            return k, alone
        k += 2


def shared(sets: dict[str, set[str]]) -> int:
    """K-mers that more than one template has."""
    seen: dict[str, int] = {}
    for own in sets.values():
        for x in own:
            seen[x] = seen.get(x, 0) + 1
    return sum(n > 1 for n in seen.values())


def contaminant_only(contaminant: str, reference: str, k: int = 12) -> list[str]:
    """The contaminant's k-mers that the reference doesn't have, sorted."""
    return sorted(every(contaminant, k) - every(reference, k))
