"""Digests of whole licence texts and standard headers in canonical form: licence, digest, opening and length (see ``licenses``).

Texts with and without what follows their terms; copyright lines are no part of the form. AGPL-3.0: its header only.
"""

#: Fixed values, of public texts.
WHOLE = [
    ("AGPL-3.0-or-later", "c0ad612dff09f3a46d284cd6326222f812128e76a7a058c916379ff339c394ba", "this program is ", 610),
    ("Apache-2.0", "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a", "apache license v", 8838),
    ("Apache-2.0", "7a46cf4a5d56898d746584f4fe57bdf571d600a8f39d21063431d88929f803c7", "licensed under t", 501),
    ("Apache-2.0", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2", "apache license v", 9882),
    ("Apache-2.0", "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0", "apache license v", 8866),
    ("BSD-2-Clause", "8027774096368556510a578ff4d19ab28b8072aa988cce24dfe85b7afbee8999", "redistribution a", 1191),
    ("BSD-2-Clause", "925e3306eb4a5616de812ebe7636c82195825e66ae2e33f8b7f4a9697c78b03b", "redistribution a", 1195),
    ("BSD-3-Clause", "80e928d346053a16374bd8965df8b724bde7813286c7acf4e9c041e405fcddc8", "redistribution a", 1377),
    ("BSD-3-Clause", "ab899150d08a3ccf837f742a20fbd8dd108031100312f3224aa5e2d14e0d60f1", "redistribution a", 1383),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", "creative commons", 6692),
    ("GPL-2.0", "611467176757b44c5c63b6b18b9b61a9e3d7bd13d738d6dde1cdce99fb1f12ef", "gnu general publ", 14451),
    ("GPL-2.0", "a76cc6ce70778ba70e43b9b1838f9e3f88b3fc7c5acbb3b8a9847918003b63e0", "gnu general publ", 14479),
    ("GPL-2.0", "ae2be2aaa68f5e52ef402874fc8c7c691879b445cb12e49d84f88168cc2d7dd6", "gnu general publ", 17113),
    ("GPL-2.0-or-later", "3606e919f92e4862a5628788f284c07f5a0ca41b819f88414d7e825dca4facc4", "this program is ", 657),
    ("GPL-3.0", "158302bba42ffffd9ebd468b95aca480c990d662430ac44bb2edba378ebeb545", "gnu general publ", 30959),
    ("GPL-3.0", "42b67f6c2a10d2b6cb4c48a2c1a454953ad6d664174e0493c9d92e45feb4b408", "gnu general publ", 33397),
    ("GPL-3.0", "4a9083dfa89bea4f460e373a4c7a4645205d5e3d3be775d544b10357e357f57b", "gnu general publ", 30957),
    ("GPL-3.0", "53a654ec022bebac4b8c6908b7a8d7e2b63dd0b041d77833e8af6b3913048c9b", "gnu general publ", 30931),
    ("GPL-3.0", "7ffc4b405b2d22c9a01c3a22db88495dbca721fad42a69191637c049f0108153", "gnu general publ", 30929),
    ("GPL-3.0", "ee0d2b91860148fdc6916d4fbea5723c7b0c7330d7a45ee71fabe123ce7175f8", "gnu general publ", 33395),
    ("GPL-3.0-or-later", "b1165b3a9c3ac2638585a8adb6e0c10814b7d97627160747134355b2690ff5af", "this program is ", 589),
    ("LGPL-2.1", "65484d3c9f900f96945bd4e6c5397aaa24f93bdc8f720eae06fbd377c62cfe97", "gnu lesser gener", 23361),
    ("LGPL-2.1", "9c2c2afdce244f7835e438f43966f864ce47d82ebd6316bbcb123927f3280e30", "gnu lesser gener", 23333),
    ("LGPL-2.1", "ed875dac9045cba09a17867210991f3a4a82f80b82096b054560a3a8dae9d692", "gnu lesser gener", 25213),
    ("LGPL-2.1-or-later", "38fd334a43235dc3cc9b4054ff7eda2187759f1748f276e846fe99c0d3225c0f", "this library is ", 680),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", "gnu lesser gener", 7104),
    ("LGPL-3.0-or-later", "d55f73055e58bb45ba8eca26bfe5f3b91426e2cfede6a66456ef0a7b34ed1ae9", "this program is ", 610),
    ("MPL-2.0", "075fcdf87448c49dbad8c5f7963f0eb6907a3d8eae1b431ba2988508499ec0de", "mozilla public l", 13661),
    ("MPL-2.0", "acb0bece3dc447740b87a4db23e0d425157552e4a33f273241a94444c2368900", "this source code", 184),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a", "mozilla public l", 14341),
    ("Unlicense", "e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229", "this is free and", 1170),
]
