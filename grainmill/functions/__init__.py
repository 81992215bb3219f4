"""grainmill.functions"""
