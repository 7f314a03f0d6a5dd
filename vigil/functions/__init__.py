"""Column-expression helpers (all JVM-side, inside whole-stage codegen)."""

from vigil.functions.columns import (argmax, class_lookup, event_key, f32_finite,
                                     finite_or_zero, hash_uniform, is_finite,
                                     lcg_hash, softmax, to_day)

__all__ = ["argmax", "class_lookup", "event_key", "f32_finite", "finite_or_zero",
           "hash_uniform", "is_finite", "lcg_hash", "softmax", "to_day"]
