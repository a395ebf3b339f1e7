"""Example registries (YAML) and the step list that uses them."""

import os

HERE = os.path.dirname(os.path.abspath(__file__))

# (step name, kind); the registry is the file of the step's name
DEFAULT_STEPS = [("check_input", "validate"), ("sort", "dispatch"), ("complete", "transform"),
                 ("check_limits", "validate"), ("deliver", "dispatch")]


def default_steps():
    return [(name, kind, os.path.join(HERE, f"{name}.yaml")) for name, kind in DEFAULT_STEPS]
