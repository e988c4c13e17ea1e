"""Which transcripts a call may rest on: policies by name, and those that are refused with a reason."""

from __future__ import annotations

# A policy's passes in order, each with the annotator's flags; the first makes the call.
POLICIES: dict[str, tuple[tuple[str, tuple[str, ...]], ...]] = {
    "mane_select_tiered": (("primary", ("-tag", "MANE_Select")), ("secondary", ())),
}
REFUSED = {
    "canon": "the longest coding sequence is not the selected transcript",
    "all_transcripts": "a loss of function on any transcript would let partial ones make the call",
}
PASSES = ("primary", "secondary")


def register(name: str, passes: tuple[tuple[str, tuple[str, ...]], ...]) -> None:
    """Adds a policy; a name that is taken or refused, or passes of other names or order, are errors."""
    if name in POLICIES or name in REFUSED:
        raise ValueError(f"the policy {name!r} exists already" if name in POLICIES else f"the policy {name!r} is refused: {REFUSED[name]}")
    if tuple(n for n, _ in passes) != PASSES[: len(passes)] or not passes:
        raise ValueError(f"a policy has the passes {PASSES}, the first at least, in this order")
    POLICIES[name] = passes


def policy(name: str) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The passes of a policy; one that is refused or unknown is an error that says why."""
    if name in REFUSED:
        raise ValueError(f"the policy {name!r} is refused: {REFUSED[name]}")
    if name not in POLICIES:
        raise ValueError(f"no policy is named {name!r}; there are {sorted(POLICIES)}")
    return POLICIES[name]
