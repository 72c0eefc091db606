"""Folders that several test modules read."""
import os

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
