"""End-to-end plans (E1-E6): compositions of the operators over a vintage layout."""

from recordlake.plans.lca import compile_lca, clean_lca
from recordlake.plans.perm import compile_perm, clean_perm
from recordlake.plans.pw import compile_pw
from recordlake.plans.refresh import refresh

__all__ = ["compile_lca", "clean_lca", "compile_perm", "clean_perm", "compile_pw", "refresh"]
