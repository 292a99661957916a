"""Content-derived identities and the split rules built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Role aliases of session messages.
ROLE_ALIASES = {
    "human": "user", "user": "user", "developer": "system", "system": "system", "assistant": "assistant", "agent": "assistant", "model": "assistant",
    "gemini": "assistant", "bot": "assistant", "tool": "tool", "function": "tool", "tool_result": "tool", "tool-result": "tool",
}
#: Provider aliases; others are unknown.
PROVIDER_ALIASES = {
    "claude": "claude", "claude-code": "claude", "claude-desktop": "claude", "codex": "codex", "cursor": "cursor", "cursor-agent-cli": "cursor",
    "cursor-aiservice": "cursor", "cursor-chat": "cursor", "cursor-global-composer": "cursor", "cursor-workspace-composer": "cursor",
    "continue": "continue", "gemini": "gemini", "gemini-cli": "gemini", "opencode": "opencode", "opencode-cli": "opencode", "opencode-desktop": "opencode",
    "prime-agent": "prime-agent", "prime": "prime-agent", "pi-agent": "pi-agent", "pi": "pi-agent", "oh-my-pi": "oh-my-pi", "ohmypi": "oh-my-pi",
    "trae": "trae", "windsurf": "windsurf", "windsurf-agent": "windsurf", "windsurf-chat": "windsurf",
}
#: Model tier aliases.
TIER_ALIASES = {
    "tier1": "tier1_frontier", "tier1_frontier": "tier1_frontier", "frontier": "tier1_frontier", "tier2": "tier2_open_source",
    "tier2_open_source": "tier2_open_source", "open_source": "tier2_open_source", "opensource": "tier2_open_source", "tier3": "tier3_local",
    "tier3_local": "tier3_local", "local": "tier3_local", "self_hosted": "tier3_local", "unclassified": "unclassified", "unknown": "unclassified",
}
#: Lanes a source may select; absent is the first.
LANES = ("primary", "optional_alt", "quarantine")


def digest(text: Column) -> Column:
    """SHA-256 in hexadecimal; null stays null."""
    return F.sha2(text.cast("string"), 256)


def content_id(**fields: Column) -> Column:
    """``sha256:`` identity of the canonical JSON of the fields: sorted keys, nulls kept."""
    ordered = F.struct(*(fields[k].alias(k) for k in sorted(fields)))
    return F.concat(F.lit("sha256:"), digest(F.to_json(ordered, {"ignoreNullFields": "false"})))


def bucket(hex_digest: Column, modulus: int) -> Column:
    """First eight hex digits of a digest as a number, modulo ``modulus``."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("long") % modulus


def three_way_split(hex_digest: Column) -> Column:
    """90 / 5 / 5 by bucket of the example's own identity."""
    b = bucket(hex_digest, 100)
    return F.when(b < 90, "train").when(b < 95, "validation").otherwise("test")


def low_percent_split(parent: Column, percent: int) -> Column:
    """Validation below ``percent`` of the parent's bucket of 100."""
    return F.when(bucket(digest(parent), 100) < percent, "validation").otherwise("train")


def high_bucket_split(parent: Column, modulus: int, first: int) -> Column:
    """Validation from bucket ``first`` on."""
    return F.when(bucket(digest(parent), modulus) >= first, "validation").otherwise("train")


def aliased(value: Column, aliases: dict[str, str]) -> Column:
    """Value of a literal map, null where it has none."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv)), value)


def token(value: Column) -> Column:
    """Trimmed of all white space; null where nothing is left."""
    return F.nullif(F.regexp_replace(value.cast("string"), r"^[\s\u00a0\u3000]+|[\s\u00a0\u3000]+$", ""), F.lit(""))


def field_key(key: Column) -> Column:
    """Field names for policy checks: lower case, hyphens and spaces as underscores."""
    return F.translate(F.lower(key), "- ", "__")


def canonical_role(role: Column) -> Column:
    """Known roles by their aliases; unknown ones become null."""
    return aliased(F.replace(F.lower(token(role)), F.lit(" "), F.lit("_")), ROLE_ALIASES)


def canonical_provider(source: Column) -> Column:
    """Known providers by their aliases, ``unknown`` otherwise."""
    return F.coalesce(aliased(F.translate(F.lower(token(source)), "_", "-"), PROVIDER_ALIASES), F.lit("unknown"))


def canonical_tier(tier: Column) -> Column:
    """Known model tiers by their aliases; null otherwise."""
    return aliased(field_key(token(tier)), TIER_ALIASES)


def lane(told: Column) -> Column:
    """The lane told, the first where none is, quarantine for unknown ones."""
    t = token(told)
    return F.when(t.isNull(), LANES[0]).when(t.isin(*LANES), t).otherwise("quarantine")


def canonical_size(value: Column) -> Column:
    """Characters of a struct's or map's canonical JSON."""
    return F.length(F.to_json(value, {"ignoreNullFields": "false"})).cast("long")


def bare_digest(told: Column) -> Column:
    """64 hexadecimal digits, lower-cased, with or without their prefix; null otherwise."""
    return F.nullif(F.regexp_extract(F.lower(told), r"^(?:sha256:)?([0-9a-f]{64})$", 1), F.lit(""))


def call_label(action: Column, call: Column) -> Column:
    """Call id by place: ``call_a0001_c01``."""
    return F.format_string("call_a%04d_c%02d", action.cast("int"), call.cast("int"))


def action_signature(name: Column, arguments: Column) -> Column:
    """Digest of a tool's name and its arguments (canonical JSON text)."""
    return digest(F.concat_ws("\u0000", name, arguments))


def user_group(explicit: Column, prompts: Column) -> Column:
    """Explicit prompt group, or one of the user texts in order; null without either."""
    made = F.concat(F.lit("sha256:"), digest(F.to_json(prompts)))
    return F.coalesce(F.nullif(explicit, F.lit("")), F.when(F.size(prompts) > 0, made))


def unit_id(fallback: Column, *ids: Column) -> Column:
    """The first id that is not empty, else a digest of the whole row's text."""
    return F.coalesce(*(F.nullif(i.cast("string"), F.lit("")) for i in ids), F.concat(F.lit("sha256:"), digest(fallback)))


def open_path(path: Column) -> Column:
    """A JSON path with its array places left open."""
    return F.regexp_replace(path, r"\[\d+\]", "[]")


def caps(text: Column) -> Column:
    """``name=count,...`` as a map of numbers."""
    return F.transform_values(F.str_to_map(F.regexp_replace(text, r"\s+", ""), F.lit(","), F.lit("=")), lambda k, v: F.try_to_number(v, F.lit("999999999")).cast("long"))


def tag_values(tags: Column, prefix: str) -> Column:
    """Values of the tags with a prefix, distinct and sorted."""
    own = F.filter(tags, lambda t: F.startswith(t, F.lit(prefix)))
    return F.array_sort(F.array_distinct(F.transform(own, lambda t: F.substring(t, F.lit(len(prefix) + 1), F.length(t)))))
