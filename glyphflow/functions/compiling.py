"""Task operations as rule programs, the inverse of the Column builders; each holds for all values over its alphabet.

Several operations in a row become one program: every stage but the last works on letters of its own, so that no rule of
one stage can match what another has made. A cursor that passes once from left to right respells the letters between two.
"""

from __future__ import annotations

from glyphflow.functions.rules import RESERVED
from glyphflow.functions.strings import PER_CHARACTER, Operation, fused, image

#: Printable characters that rules can hold, capitals first.
SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(c for c in map(chr, range(33, 127)) if c not in RESERVED and not c.isupper())


class Marks:
    """Hands out characters that nothing else uses."""

    def __init__(self, *used: str):
        self.used = set("".join(used))

    def take(self, n: int) -> str:
        free = [c for c in SIGNS if c not in self.used][:n]
        if len(free) < n:
            raise NotImplementedError("there aren't enough characters for the marks")
        self.used.update(free)
        return "".join(free)


def texts_of(op: Operation) -> str:
    """All characters that an operation's parameters bring in."""
    p = op.parameters
    flat = [*p.get("mapping", {}), *p.get("mapping", {}).values(), *(p.get(k, "") for k in ("old", "new", "pattern", "accept", "reject", "symbols", "order", "separator", "symbol"))]
    if "delta" in p:
        flat += [x for (_, c), t in p["delta"].items() for x in (c, t[1] if isinstance(t, tuple) else "")]
    if op.kind == "unary_operation":
        flat += {"binary_increment": ["01"]}.get(p["operation"], [p.get("symbol", "a")])
    return "".join(flat) + ("truefalse" if op.kind in ("accept", "recognize_pattern") else "")


def after(op: Operation, alphabet: str) -> str:
    """The characters that an operation's results can have."""
    if op.kind in PER_CHARACTER:
        images = image(op)
        return "".join(sorted({x for c in alphabet for x in images.get(c, c)}))
    if op.kind == "replace_substring":
        return "".join(sorted({*alphabet, *op.parameters["new"]}))
    if op.kind == "transduce":
        return "".join(sorted({x for _, out in op.parameters["delta"].values() for x in out}))
    if op.kind == "unary_operation":
        return "01" if op.parameters["operation"] == "binary_increment" else op.parameters.get("symbol", "a")
    return alphabet


def passing(mark: str, images: dict[str, str], first: list[str] | None = None) -> list[str]:
    """A cursor goes through the value once and leaves images behind it, which no rule here looks at again."""
    return [f"(once)={mark}", *(first or []), *(f"{mark}{c}={to}{mark}" for c, to in images.items()), f"{mark}="]


def reversing(alphabet: str, marks: Marks) -> list[str]:
    """The letter after the cursor steps back over all that was reversed before, marked on its way."""
    cursor, moving = marks.take(1), dict(zip(alphabet, marks.take(len(alphabet)), strict=True))
    back = [f"{d}{moving[c]}={moving[c]}{d}" for c in alphabet for d in alphabet]
    return [f"(once)={cursor}", *back, *(f"(start){m}={c}" for c, m in moving.items()), *(f"{cursor}{c}={moving[c]}{cursor}" for c in alphabet), f"{cursor}="]


def turning(alphabet: str, amount: int, direction: str, marks: Marks) -> list[str]:
    """One letter to the other end for each mark; a mark is set when the one before is gone."""
    m = marks.take(1)
    if direction == "left":
        return [*(f"(start){m}{c}=(end){c}" for c in alphabet), f"{m}=", *[f"(once)={m}"] * amount]
    return [*(f"(end){c}{m}=(start){c}" for c in alphabet), f"{m}=", *[f"(once)=(end){m}"] * amount]


def automaton(op: Operation, alphabet: str, marks: Marks) -> list[str]:
    """A cursor for each state eats the letters; a transition that is missing rejects."""
    delta = op.parameters["delta"]
    states = sorted({op.parameters["start"], *(s for s, _ in delta), *(t[0] if op.kind == "transduce" else t for t in delta.values())})
    mark = dict(zip(states, marks.take(len(states)), strict=True))
    out = [f"(once)={mark[op.parameters['start']]}"]
    for s in states:
        for c in alphabet:
            if (s, c) not in delta:
                raise NotImplementedError(f"no transition from {s} on {c}")
            to, said = delta[s, c] if op.kind == "transduce" else (delta[s, c], "")
            out.append(f"{mark[s]}{c}={said}{mark[to]}")
    if op.kind == "transduce":
        return out + [f"{mark[s]}=" for s in states]
    return out + [f"{mark[s]}=(return){'true' if s in op.parameters['accepting'] else 'false'}" for s in states]


def stage(op: Operation, alphabet: str, marks: Marks) -> list[str]:
    """The rules of one operation."""
    p = op.parameters
    if op.kind == "delete":
        return [f"{c}=" for c in p["symbols"]]
    if op.kind in PER_CHARACTER:
        images = image(op)
        return passing(marks.take(1), {c: images.get(c, c) for c in alphabet})
    if op.kind == "replace_substring" and p["old"]:
        m = marks.take(1)
        return passing(m, {c: c for c in alphabet}, [f"{m}{p['old']}={p['new']}{m}"])
    if op.kind == "normalize_runs":
        return [f"{c}{c}={c}" for c in p["symbols"]]
    if op.kind == "move_symbols":
        order = p["order"]
        return [f"{b}{a}={a}{b}" for i, a in enumerate(order) for b in order[i + 1 :]]
    if op.kind == "recognize_pattern":
        return [f"{p['pattern']}=(return){p.get('accept', 'true')}", f"=(return){p.get('reject', 'false')}"]
    if op.kind == "reverse":
        return reversing(alphabet, marks)
    if op.kind == "rotate":
        return turning(alphabet, p["amount"], p.get("direction", "left"), marks)
    if op.kind in ("accept", "transduce"):
        return automaton(op, alphabet, marks)
    if op.kind == "unary_operation":
        a, kind = p.get("symbol", "a"), p["operation"]
        if kind == "increment":
            return [f"(once)=(end){a}"]
        if kind == "decrement":
            return [f"(once){a}="]
        if kind == "parity":
            raise NotImplementedError("parity is a test of a number, not a rewriting of it")
        m = marks.take(1)
        return [f"(once)={m}", f"{m}{a}={a}{a}{m}", f"{m}="] if kind == "double" else [f"(once)=(end){m}", f"0{m}=1", f"1{m}={m}0", f"{m}=1"]
    if op.kind == "binary_operation" and (p["operation"] == "concat" or p["operation"] == "add" and p.get("representation", "unary") == "unary"):
        return [f"(once){p['separator']}="]
    if op.kind == "binary_operation" and p["operation"] == "subtract" and p.get("representation", "unary") == "unary":
        a, m = p.get("symbol", "a"), p["separator"]
        return [f"{a}{m}{a}={m}", f"{m}{a}={m}", f"{m}="]
    raise NotImplementedError(f"no rules for {op.kind} with {p}")


def ends_in_return(rules: list[str]) -> bool:
    return any("=(return)" in r for r in rules)


def respelled(op: Operation, to: dict[str, str]) -> Operation:
    """op over other letters."""
    spell = lambda x: "".join(to.get(c, c) for c in x)
    p = dict(op.parameters)
    for k in ("old", "new", "pattern", "symbols", "order", "separator", "symbol"):
        if k in p:
            p[k] = spell(p[k])
    if "mapping" in p:
        p["mapping"] = {spell(k): spell(x) for k, x in p["mapping"].items()}
    if "delta" in p:
        p["delta"] = {(s, spell(c)): (t[0], spell(t[1])) if isinstance(t, tuple) else t for (s, c), t in p["delta"].items()}
    return Operation(op.kind, p)


def compiled(op: Operation | list[Operation], alphabet: str) -> str:
    """The rules of an operation, or of several in a row; NotImplementedError for parameters that have none here.

    An operation whose program returns a fixed text can only be the last one. Unary and binary arithmetic inside a row
    keep their own letters, so that they can only be first or last.
    """
    operations = fused([op] if isinstance(op, Operation) else list(op))
    marks = Marks(alphabet, *map(texts_of, operations))
    if len(operations) < 2:
        return "\n".join(r for o in operations for r in stage(o, alphabet, marks))
    rules, letters = [], alphabet
    spelling = dict(zip(letters, marks.take(len(letters)), strict=True))
    rules += passing(marks.take(1), spelling)
    for i, o in enumerate(operations):
        last = i == len(operations) - 1
        if o.kind in ("unary_operation", "binary_operation") and not last:
            raise NotImplementedError(f"{o.kind} can only be the last operation")
        made = after(o, letters)
        spelling |= dict(zip([c for c in made if c not in spelling], marks.take(len([c for c in made if c not in spelling])), strict=True))
        own = stage(o if last else respelled(o, spelling), letters if last else "".join(spelling[c] for c in letters), marks)
        if not last and ends_in_return(own):
            raise NotImplementedError(f"{o.kind} ends the program")
        rules += own
        if not last:
            # the letters of the next stage: plain ones for the last, else new ones
            ours = {c: spelling[c] for c in made}
            theirs = {c: c for c in made} if i == len(operations) - 2 else dict(zip(made, marks.take(len(made)), strict=True))
            cursor = marks.take(1)
            respell = [f"{cursor}{ours[c]}={theirs[c]}{cursor}" for c in made]
            rules = [*respell, f"{cursor}=", *rules, f"(once)={cursor}"]
            spelling, letters = dict(theirs), made
    return "\n".join(rules)
