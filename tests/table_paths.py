"""Where the given tables lie. A module of its own: ``conftest`` names whichever conftest.py was loaded last."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
