"""The posting pipeline (landing -> staging -> mart) and the analytics on the mart."""
