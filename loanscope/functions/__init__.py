"""Scalar ``Column`` builders (the X-operators of the survey)."""

from loanscope.functions.scalars import *  # noqa: F401,F403
