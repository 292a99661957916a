"""Long sessions to bounded, linked segments: rules of several builders over one record at a time.

A cut depends on the cuts before it, so a record's messages are taken in order;
records are independent and go through ``records.each``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from sessionweave.functions.identity import ROLE_ALIASES
from sessionweave.operators.records import ANSWERS, ARTIFACTS, CALLS, CONTEXTS, IDS, MESSAGES, RESULTS, canonical, first, listed, objects, parts_of, sha, token, key_of

TARGET = 0.55
FULL = 0.7


def role_of(m) -> str | None:
    return ROLE_ALIASES.get((token(m.get("role") or m.get("type")) or "").lower().replace(" ", "_")) if isinstance(m, dict) else None


def size_of(m) -> int:
    """Characters that a message will take: its own, and again what becomes events."""
    n = len(canonical(m)) + 1
    if not isinstance(m, dict):
        return n
    if role_of(m) == "tool":
        n += len(canonical(m.get("content", m.get("message", m.get("text", ""))))) + 1
    return n + sum(len(canonical(m[k])) + 1 for k in (*CALLS, *RESULTS, *ARTIFACTS, *CONTEXTS) if k in m)


def _ids(m: dict, keys: tuple, kinds: set) -> set[str]:
    found = [e for k in keys if k in m for e in listed(m[k])] + [p for p in parts_of(m.get("content")) if key_of(p.get("type")) in kinds]
    return {str(i) for e in objects(found) if (i := first(e, IDS)) is not None}


def asked(m) -> set[str]:
    return _ids(m, CALLS, {"tool_use", "tool_call"}) if isinstance(m, dict) else set()


def answered(m) -> set[str]:
    if not isinstance(m, dict):
        return set()
    own = first(m, ANSWERS) if role_of(m) == "tool" else None
    return _ids(m, RESULTS, {"tool_result", "tool_response"}) | ({str(own)} if own is not None else set())


class Segment:
    """Messages of a segment under way."""

    def __init__(self, prefix: list, start: int, anchor: tuple | None = None):
        self.messages = [*prefix, *([anchor[1]] if anchor else [])]
        self.size = sum(map(size_of, self.messages))
        self.start, self.anchor = start, anchor[0] if anchor else None
        self.user, self.assistant, self.last_user, self.open = bool(anchor), False, anchor, set()

    def take(self, k: int, m) -> None:
        role = role_of(m)
        self.messages.append(m)
        self.size += size_of(m)
        self.user, self.assistant = self.user or role == "user", self.assistant or role == "assistant"
        self.last_user = (k, m) if role == "user" else self.last_user
        self.open = (self.open - answered(m)) | asked(m)


def safe_cut(s: Segment, m) -> bool:
    """Before a user turn, or before an answer that follows a whole answer or its tool; never while a call is open."""
    role, last = role_of(m), s.messages[-1]
    if s.open:
        return False
    if role == "user":
        return True
    return role != "tool" and ((role_of(last) == "assistant" and not asked(last) and not any(k in last for k in CALLS)) or (role_of(last) == "tool" and role == "assistant"))


def any_cut(s: Segment, m) -> bool:
    """As above, but calls that were never answered do not hold a segment open beyond their own results."""
    return role_of(m) != "tool" or not (answered(m) & s.open)


def cut(messages: list, target: int, may: Callable[[Segment, object], bool] = safe_cut, early: float | None = None) -> Iterator[tuple[list, int, int, int | None]]:
    """``(messages, first, last, anchor)`` of each segment.

    Leading system messages are repeated in all; a segment is cut only once it
    holds a user and an assistant and the next message would exceed the target
    (or, with ``early``, a user turn comes when it is that full).  A cut before
    an answer carries the last user turn over as context.
    """
    head = next((k for k, m in enumerate(messages) if role_of(m) != "system"), len(messages))
    s = Segment(messages[:head], head)
    for k in range(head, len(messages)):
        m = messages[k]
        over = s.size + size_of(m) > target or (early is not None and role_of(m) == "user" and s.size >= int(target * early))
        if s.user and s.assistant and over and may(s, m):
            yield s.messages, s.start, k - 1, s.anchor
            s = Segment(messages[:head], k, s.last_user if role_of(m) != "user" else None)
        s.take(k, m)
    if s.messages:
        yield s.messages, s.start, len(messages) - 1, s.anchor


def variants(record: dict, most: int, share: float = TARGET, may: Callable = safe_cut, early: float | None = None) -> list[dict]:
    """A record as segments of about ``share`` of the bound, stamped with where they stand; a short one as it is."""
    key = next((k for k in MESSAGES if isinstance(record.get(k), list)), None)
    target = max(1, int(most * share))
    if key is None or len(record[key]) < 2 or sum(map(size_of, record[key])) <= target:
        return [record]
    made = list(cut(record[key], target, may, early))
    if len(made) < 2:
        return [record]
    parent = sha(canonical(record))
    detached = {k: v for k, v in record.items() if k in (*CALLS, *RESULTS, *ARTIFACTS, *CONTEXTS)}
    out = []
    for n, (messages, start, end, anchor) in enumerate(made):
        base = record if n == 0 else {k: v for k, v in record.items() if k not in detached}  # what is of no message stays with the first
        stamp = {
            "_chunk_parent_record_sha256": parent, "_chunk_index": n, "_chunk_count": len(made), "_chunk_message_start": start, "_chunk_message_end": end,
            "_chunk_cut_reason": "token_budget",
        }
        out.append(base | {key: messages} | stamp | ({"_chunk_anchor_message_index": anchor} if anchor is not None else {}))
    return out


def rollout_variants(record: dict, most: int) -> list[dict]:
    """Segments of a quarter of the bound; unanswered calls do not hold one open."""
    return variants(record, most, 0.25, any_cut)


def store_variants(record: dict, most: int) -> list[dict]:
    """Segments that also end at a user turn when they are mostly full."""
    return variants(record, most, TARGET, lambda s, m: True, FULL)


def log_variants(record: dict, most: int) -> list[dict]:
    """Segments of a quarter of the bound with the last user turn carried over."""
    return variants(record, most, 0.25)


def groups(payloads: list, target: int) -> Iterator[tuple[list, int, int]]:
    """Neighbouring payloads up to a budget, with the first and last place."""
    held, size, start = [], 0, 0
    for k, p in enumerate(payloads):
        n = len(canonical(p)) + 1
        if held and size + n > target:
            yield held, start, k - 1
            held, size, start = [], 0, k
        held.append(p)
        size += n
    if held:
        yield held, start, start + len(held) - 1


def bounded_value(value, most: int, mark: str, share: float = 0.7) -> tuple[object, str]:
    """A payload up to a size: text keeps its head and tail around the mark, anything else becomes its digest."""
    size = len(canonical(value))
    if size <= most:
        return value, "full"
    if isinstance(value, str):
        mark = mark.format(chars=len(value), sha=sha(value))
        room = max(2, most - len(mark))
        head = max(1, int(room * share))
        return value[:head] + mark + value[-max(1, room - head) :], "truncated"
    return {"truncated": True, "sha256": "sha256:" + sha(canonical(value)), "serialized_chars": size}, "digest_only"


#: Marks of what was cut.
WINDOW_MARK = "\n<OBSERVATION_TRUNCATED_FOR_ACTION_WINDOW>\n"
OBSERVATION_MARK = "\n<OBSERVATION_TRUNCATED chars={chars} sha256={sha}>\n"
