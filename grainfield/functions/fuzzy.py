"""Similarity by the longest common subsequence, as bit-parallel folds."""

from __future__ import annotations


def lcs(d, a: str, b: str) -> str:
    """Length of the longest common subsequence of a and b, a the pattern: one bit per character of a.

    With masks M of a's characters, each character c of b takes U = V & M[c] and V = (V + U) | (V - U); the zeros
    left in V are the length. Spark folds in 60-bit integers and, for longer patterns, row by row of the usual table.
    """
    if d.name == "duck":
        mask = f"list_reduce(list_transform(range(1, length({a}) + 1), lambda i_: case when substring({a}, i_, 1) = substring({b}, j_::bigint, 1) then 1::hugeint << (i_ - 1)::int else 0::hugeint end), lambda p_, q_: p_ + q_, 0::hugeint)"
        full = f"((1::hugeint << length({a})::int) - 1)"
        fold = f"list_reduce(list_transform(range(1, length({b}) + 1), lambda z_: z_::hugeint), lambda v_, j_: ((v_ + (v_ & {mask})) | (v_ - (v_ & {mask}))) & {full}, {full})"
        return f"(length({a}) - bit_count({fold}))"
    mask = f"aggregate(sequence(1, length({a})), 0L, (s_, i_) -> s_ + if(substring({a}, i_, 1) = substring({b}, j_, 1), shiftleft(1L, i_ - 1), 0L))"
    full = f"(shiftleft(1L, length({a})) - 1L)"
    step = f"get(transform(array(v_ & {mask}), u_ -> ((v_ + u_) | (v_ - u_)) & {full}), 0)"
    bits = f"length({a}) - bit_count(aggregate(sequence(1, length({b})), {full}, (v_, j_) -> {step}))"
    row = f"aggregate(sequence(1, length({b})), array(0), (r_, j_) -> array_append(r_, if(substring({a}, i_, 1) = substring({b}, j_, 1), get(w_, j_ - 1) + 1, greatest(get(w_, j_), get(r_, j_ - 1)))))"
    table = f"element_at(aggregate(sequence(1, length({a})), array_repeat(0, length({b}) + 1), (w_, i_) -> {row}), -1)"
    return f"(case when length({a}) = 0 or length({b}) = 0 then 0 when length({a}) <= 60 then {bits} else {table} end)"


def ratio(d, a: str, b: str) -> str:
    """0 to 100, whole; two empty texts are alike."""
    return f"(case when length({a}) + length({b}) = 0 then 100e0 when length({a}) = 0 or length({b}) = 0 then 0e0 else round(200e0 * {lcs(d, a, b)} / (length({a}) + length({b})), 0) end)"


def processed_words(d, x: str) -> str:
    """Lower-case words of letters and digits."""
    text = d.replace_all(f"lower({x})", r"[^\p{L}\p{N}]+", " ")
    return f"filter(split({text}, ' '), w_ -> w_ <> '')" if d.name == "spark" else f"list_filter(string_split({text}, ' '), lambda w_: w_ <> '')"


def sorted_words(d, x: str) -> str:
    """U2's form: the words in order, joined."""
    return f"array_join(array_sort({processed_words(d, x)}), ' ')" if d.name == "spark" else f"array_to_string(list_sort({processed_words(d, x)}), ' ')"


def set_forms(d, a: str, b: str) -> tuple[str, str, str]:
    """U3's forms: common words; with those only in a; with those only in b."""
    x, y = processed_words(d, a), processed_words(d, b)
    if d.name == "spark":
        join = lambda s: f"trim(array_join(array_sort({s}), ' '))"
        both, left, right = f"array_intersect({x}, {y})", f"array_except({x}, {y})", f"array_except({y}, {x})"
    else:
        join = lambda s: f"trim(array_to_string(list_sort(list_distinct({s})), ' '))"
        both, left, right = f"list_intersect({x}, {y})", f"list_filter({x}, lambda w_: not list_contains({y}, w_))", f"list_filter({y}, lambda w_: not list_contains({x}, w_))"
    common = join(both)
    return common, f"trim(concat({common}, ' ', {join(left)}))", f"trim(concat({common}, ' ', {join(right)}))"
