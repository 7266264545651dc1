"""Set-oriented decisions: diaries, graphs of phases, lifecycles, points and splitting."""
